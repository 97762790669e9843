"""Odd documents every operator must take."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size int, node string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "  \n\t ", "en", "a", 5),
    (4, "one two three four five six seven", "en", "a", 33),
    (5, "ONE two three four five six seven", "en", None, 33),
    (6, "one two three four five six seven", "en", "b", 33),
    (6, "one two three four five six seven", "en", "b", 33),
    (7, "word", "en", "b", 4),
    (8, "word", "en", "", 4),
    (None, "some text without a key at all, really", "en", "b", 38),
    (9, "long " * 3000 + "end", "en", "a", 15003),
    (10, "x" * 20000, "en", "a", 20000),
    (11, "mail a.b@c.org and +1 (269) 555-3296 4539 1488 0343 6467 or 10.0.0.1, 999.1.1.1\nnew ünicode 😀 line", "de", "b", 90),
    (-5, "tab\tand\x0bvertical\x0cfeed\r\nline ▁ <0x0A> </s>", "fr", "Z", 40),
]


def documents(spark, rows=ODD):
    """The rows with further columns, whose names operators use inside."""
    return spark.createDataFrame([(*r, 0.5, 3, "node") for r in rows], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, n=4):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
