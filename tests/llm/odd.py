"""Documents and pages that operators trip over."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977}" for i in range(30_000))

#: doc_id, text, lang, source, n_chars, and columns named like results
ROWS = [
    (1, None, None, None, 0, "x"),
    (2, "", "en", "b", 0, "x"),
    (3, " \t\n\u000b ", "en", "a", 5, None),
    (4, "one", "en", "a", 3, "x"),
    (5, "the same text again, the same text again and more of it", None, "a", 10, "x"),
    (5, "the same text again, the same text again and more of it", None, "a", 10, "x"),
    (6, "the same text again, the same text again and more of it", "xx", None, 10, "x"),
    (7, LONG, "en", "c", len(LONG), "x"),
    (None, "no id here\nbut two lines", "en", "c", 20, "x"),
    (8, "a\u0000b ﻿ \U0001f642 ́ é <|endoftext|>", "en", "c", 9, "x"),
]
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, taken string, kept string, "
    "score string, n_tokens string, fingerprint string, `od.d` string"
)


def frame(spark, rows=None):
    rows = ROWS if rows is None else rows
    return spark.createDataFrame([(*r, *[r[-1]] * 6) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return [r[1] or "" for r in ROWS]
