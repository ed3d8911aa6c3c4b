"""Rows and helpers of the text operators' tests."""

from __future__ import annotations

#: Rows that every operator must take: null and empty and blank texts, null ids and
#: sources, repeated rows and ids, a very long text, and columns named like outputs.
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 4000
EDGE_ROWS = [
    (1, None, "en", "s", 0),
    (2, "", "en", "s", 0),
    (3, " \t\n ", "de", None, 0),
    (4, "one", None, "s", 0),
    (None, "a text without an id but with some words in it", "en", "s", 0),
    (5, LONG, "en", "s", 0),
    (6, "the same row twice in the table with enough words to count", "en", "s", 0),
    (6, "the same row twice in the table with enough words to count", "en", "s", 0),
    (7, "an id with two texts the first of them with many words", "en", "t", 0),
    (7, "an id with two texts and this one is the other text here", "en", "t", 0),
    (8, "Ünïcödé \U0001f600 漢字 text\x00with odd characters   and more of them", "fr", "t", 0),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("spans", "ids", "decoded", "kept", "score", "shard", "slot", "node", "region", "k0", "t", "w", "key", "id", "part", "text_key", "stratum", "a.b", "doc_id.x")


def by_id(frame, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    rows = [tuple(r[c] for c in columns) for r in frame.select(*(f"`{c}`" for c in columns)).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))
