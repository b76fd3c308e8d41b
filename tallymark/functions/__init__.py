"""Column builders: mapping rules, null handling, global rules, canonical text."""
