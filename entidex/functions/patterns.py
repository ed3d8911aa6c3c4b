"""`LIKE '%directory%'` as an equi-join.

A directory is a pattern here, not plain text: its `_` and `%` are wildcards. To
match many directories with many locations without comparing all pairs, each
pattern offers *anchors*: literal pieces of it whose length is one of a few fixed
widths. A location can only match if every anchor is one of its substrings of that
width. So an equi-join on the substrings' hashes, with the rarest anchor of each
pattern, finds every candidate, and `LIKE` then decides.

Anchors are tiles over each whole literal run, half overlapping, so whatever tells two
look-alike names apart lies inside one of them, wherever in the name it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTHS = [32, 16, 8, 4, 2, 1, 0]


def containing_pattern(directory: Column, literal: bool = False) -> Column:
    """Pattern that matches what contains `directory`; with `literal`, wildcards match only themselves.

    Spark refuses a backslash before an ordinary character, which elsewhere in SQL
    just means that character: such backslashes are dropped.
    """
    if literal:
        directory = F.regexp_replace(directory, r"([%_\\])", r"\\$1")
    pattern = F.concat(F.lit("%"), directory, F.lit("%"))
    return F.regexp_replace(pattern, r"(?s)(\\[%_\\])|\\(.)", "$1$2")


def _anchor(gram: Column) -> Column:
    """A substring as a join key. Two that share a key only make a candidate more."""
    return F.xxhash64(gram)


def anchors_of(pattern: Column) -> Column:
    """Keys of tiles over every literal run of the pattern; of an empty one only if there is no other."""

    def of_run(run: Column) -> Column:
        width = F.coalesce(*[F.when(F.length(run) >= w, F.lit(w)) for w in WIDTHS])
        step, last = F.greatest(F.floor(width / 2).cast("int"), F.lit(1)), F.length(run) - width + 1
        starts = F.array_append(F.sequence(F.lit(1), last, step), last)
        return F.transform(F.array_distinct(starts), lambda start: F.substr(run, start, width))

    runs = F.split(pattern, r"(?s)\\.|[%_]")
    longer = F.filter(runs, lambda run: run != "")
    return F.array_distinct(F.transform(F.flatten(F.transform(F.when(F.size(longer) > 0, longer).otherwise(runs), of_run)), _anchor))


def grams_of(text: Column) -> Column:
    """Keys of all substrings that `text` offers to an anchor."""

    def of_width(width: Column) -> Column:
        # A text shorter than the width gets one start, whose gram is too short and dropped.
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - width + 1, F.lit(1)))
        grams = F.transform(starts, lambda start: F.substr(text, start, width))
        return F.filter(grams, lambda gram: F.length(gram) == width)

    return F.array_distinct(F.transform(F.flatten(F.transform(F.array(*map(F.lit, WIDTHS)), of_width)), _anchor))
