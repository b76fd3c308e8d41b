"""DataFrame operators: filters, joins, row numbers, mapping, unions, aggregates, checks."""
