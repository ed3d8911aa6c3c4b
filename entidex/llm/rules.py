"""Quality rules with risk-controlled thresholds, all in DataFrame functions.

Base rules are fixed. On top, each metric (a ratio of two counts) gets a cutoff per
stratum, chosen on labelled documents so that few good ones are rejected, with proof: a
cutoff is certified if the exact binomial bound on its false rejections stays below
`ALPHA` / metrics, that is if P(Bin(n, a) <= k) <= `DELTA` / (strata x metrics), where k of
n good documents are beyond it. Cutoffs are tested from the loosest on and testing stops
at the first that fails (fixed sequence), so the whole family errs with probability
`DELTA` at most, and all metrics together reject at most `ALPHA` of the good documents of
a stratum. Of the certified cutoffs the one that pays most is taken, or none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entidex.llm.common import scratch, written
from entidex.storage import delete

#: Bound on false rejections per stratum, and on the chance that any bound is wrong.
ALPHA, DELTA = 0.05, 0.05
#: Good documents that one rejected good document outweighs (see `certified_cutoffs`).
PENALTY = 20
#: Cutoffs in percent, from the loosest on.
CUTOFFS = (90, 70, 50, 40, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2, 1)
#: Metric: (numerator, denominator), both columns of `features`.
METRICS = {
    "symbols": ("n_symbols", "word_chars"),
    "shouts": ("n_shouts", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}

#: What separates words, and what counts as a symbol.
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
WORD_LETTER = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]+"
#: Words of a window, base limits.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Most rows of cutoffs that are sent to every task; beyond, they are joined.
SENT_ROWS = 100_000


def _counted(text: Column, pattern: str) -> Column:
    """Characters of a text in runs of a pattern."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def features(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """The columns of `keep` and the counts every rule is made of, one row per document.

    A null text has no words. Repeated windows are found by sorting the window hashes
    (64 bits) within the row, and only in rows that have some: no shuffle.
    """
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    text = F.col("t")
    rows = docs.select(*kept, F.coalesce(text_col, F.lit("")).alias("t"))
    rows = rows.select(
        *(f"k{i}" for i in range(len(keep))),
        _counted(text, SYMBOLS).alias("n_symbols"),
        _counted(text, "!+").alias("n_shouts"),
        _counted(text, "[A-Z]+").alias("n_capitals"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_LETTER)).alias("lines"),
        F.filter(F.split(text, SPACE_PATTERN), lambda w: w != "").alias("words"),
    )
    rows = rows.withColumn("w", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("word_chars", F.char_length(F.array_join("words", "")).cast("long")).drop("words")
    at = lambda i, k: F.get("w", i + k)
    windows = F.when(
        F.size("w") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("w") - WINDOW), lambda i: F.xxhash64(*(at(i, k) for k in range(WINDOW)))),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("windows", windows)
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    rows = rows.withColumn("sorted", F.when(again, ordered))
    same = lambda s, i: F.coalesce(F.get("sorted", i)["h"] == s["h"], F.lit(False))
    repeated = F.sort_array(F.transform(F.filter("sorted", lambda s, i: same(s, i - 1) | same(s, i + 1)), lambda s: s["p"]))
    rows = rows.withColumn("repeated", repeated)
    covered = F.aggregate(
        "repeated",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    counts = F.struct(
        F.size("w").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_shouts",
        "n_capitals",
    )
    # A generator: later filters stay above it. Pushed below, they would repeat these
    # expressions inside one another, per word.
    return rows.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), F.inline(F.array(counts)))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def log_binomial_cdf(n: Column, k: Column, rate: float) -> Column:
    """ln P(Bin(n, rate) <= k), summed term by term in logarithms."""
    odds = math.log(rate / (1 - rate))
    first = n * math.log1p(-rate)
    return F.aggregate(
        F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.alias("term"), first.alias("total")),
        lambda a, j: (
            lambda term: F.struct(term.alias("term"), (a["total"] + F.log1p(F.exp(term - a["total"]))).alias("total"))
        )(a["term"] + F.log((n - j + 1) / j) + odds),
        lambda a: a["total"],
    )


def certified_cutoffs(counted: DataFrame, labels: DataFrame, stratum: str, id_col: str = "doc_id") -> DataFrame:
    """`stratum`, `metric`, `cutoff` (percent): reject where 100 x numerator > cutoff x denominator.

    counted: `features` with `id_col` and `stratum`. labels: `id_col`, `quality` (1 is good,
    0 is bad). A document with both labels is bad; labels without a value do not count.
    Documents that fail the base rules do not count either: they are rejected anyway. A
    null stratum is one of its own. Strata with too few good labels get no cutoff.
    """
    good = labels.filter(F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("__label")).agg((F.min("quality") >= 1).alias("good"))
    held = counted.filter(~base_failed()).join(good, F.col(id_col) == F.col("__label"))
    rows = held.select(
        F.col(stratum).alias("stratum"),
        "good",
        F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(a).alias("num"), F.col(b).alias("den")) for m, (a, b) in METRICS.items()))).alias("m"),
    )
    # One histogram cell per cutoff: the loosest cutoff a document is beyond.
    beyond = F.get(F.filter(F.array(*map(F.lit, CUTOFFS)), lambda c: 100 * F.col("m.num") > c * F.col("m.den")), F.lit(0))
    cells = rows.withColumn("cutoff", beyond).groupBy("stratum", F.col("m.metric").alias("metric"), "cutoff")
    cells = cells.agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    # Cells without a document still are tests of the sequence: complete the grid.
    totals = cells.groupBy("stratum", "metric").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    grid = totals.withColumn("cutoff", F.explode(F.array(*map(F.lit, CUTOFFS))))
    cells = cells.filter("cutoff is not null").select(F.col("stratum").alias("s"), F.col("metric").alias("m"), F.col("cutoff").alias("c"), "good", "bad")
    grid = grid.join(cells, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("metric") == F.col("m")) & (F.col("cutoff") == F.col("c")), "left")
    looser = Window.partitionBy("stratum", "metric").orderBy(F.desc("cutoff")).rowsBetween(Window.unboundedPreceding, 0)
    grid = grid.select(
        "stratum", "metric", "cutoff", "n_good", "n_bad",
        F.sum(F.coalesce("good", F.lit(0))).over(looser).alias("k_good"),
        F.sum(F.coalesce("bad", F.lit(0))).over(looser).alias("k_bad"),
    )
    rate = ALPHA / len(METRICS)
    strata = totals.select("stratum").distinct().agg(F.count("*")).scalar()
    level = F.log(F.lit(DELTA) / (strata * len(METRICS)))
    # A share of rate or more can never pass: its sum of terms need not be taken.
    passed = (F.col("k_good") < rate * F.col("n_good")) & (log_binomial_cdf(F.col("n_good"), F.col("k_good"), rate) <= level)
    tested = grid.withColumn("passed", passed).withColumn("sound", F.min(F.col("passed").cast("int")).over(looser) == 1)
    gain = F.col("k_bad") * F.col("n_good") - PENALTY * F.col("k_good") * F.col("n_bad")
    best = Window.partitionBy("stratum", "metric").orderBy(F.desc("gain"), F.desc("cutoff"))
    chosen = tested.withColumn("gain", gain).filter("sound and gain > 0").withColumn("rank", F.row_number().over(best))
    return chosen.filter("rank = 1").select("stratum", "metric", "cutoff")


def judged(counted: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """`counted` with `base_failed` and `kept`: false beyond a base rule or the stratum's cutoffs."""
    of = cutoffs.groupBy(F.col("stratum").alias("__stratum")).agg(F.map_from_entries(F.collect_list(F.struct("metric", "cutoff"))).alias("__cutoffs"))
    if cutoffs.limit(SENT_ROWS + 1).count() <= SENT_ROWS:
        of = F.broadcast(of)
    both = counted.join(of, F.col(stratum).eqNullSafe(F.col("__stratum")), "left")
    beyond = F.lit(False)
    for metric, (num, den) in METRICS.items():
        beyond = beyond | F.coalesce(100 * F.col(num) > F.col("__cutoffs")[metric] * F.col(den), F.lit(False))
    return both.withColumn("base_failed", base_failed()).withColumn("kept", ~(base_failed() | beyond)).drop("__stratum", "__cutoffs")


def assess(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `id_col`, `stratum`, the counts, `base_failed`, `kept`.

    Counts are taken once and written; cutoffs are learnt from them. Repeated rows repeat;
    an empty table gives none; other columns are not read.
    """
    folder = scratch(docs.sparkSession)
    counted = written(features(docs, id_col, stratum, text_col=text_col), folder, "counted")
    cutoffs = written(certified_cutoffs(counted, labels, stratum, id_col), folder, "cutoffs", few=True)
    return judged(counted, cutoffs, stratum)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that no rule rejects, with their own columns, whatever their names.

    A null or empty text has no words and goes; repeated rows are judged alike, each by
    itself; a null stratum is one of its own; an empty table gives none, and without labels
    only the base rules hold. All documents are counted twice: picking the labelled ones
    first would shuffle their texts wherever the labels are too many to be broadcast.
    """
    folder = scratch(docs.sparkSession)
    counted = written(features(docs, id_col, stratum, text_col=text_col), folder, "counted")
    cutoffs = written(certified_cutoffs(counted, labels, stratum, id_col), scratch(docs.sparkSession), "cutoffs", few=True)
    delete(docs.sparkSession, folder)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at = dict(zip(docs.columns, plain.columns))
    whole = plain.select(F.struct(*plain.columns).alias("row"), F.col(at[stratum]).alias("stratum_of"), F.col(at[text_col]).alias("text_of"))
    verdicts = judged(features(whole, "row", "stratum_of", text_col="text_of"), cutoffs, "stratum_of")
    return verdicts.filter("kept").select("row.*").toDF(*docs.columns)
