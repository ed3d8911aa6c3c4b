"""Quality rules and sharding."""

import math
import random
import zlib
from collections import Counter

import oracle
import pytest
from conftest_llm import EDGE_ROWS, by_id
from entidex.llm import rules, shards
from entidex.llm.queries import QUERIES, SQL
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", ["op9_quality_rules", "op10_shards"])
def test_twin(spark, sf_dir, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), SQL[name], oracle.connect(sf_dir)) is None


@pytest.mark.parametrize("name", ["op9_quality_rules", "op10_shards"])
def test_plans_have_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))


@pytest.mark.parametrize("n, k, rate", [(10, 0, 0.1), (50, 3, 0.1), (2000, 5, 0.01), (100_000, 900, 0.01)])
def test_binomial_tail(spark, n, k, rate):
    got = spark.range(1).select(rules.log_binomial_cdf(F.lit(n).cast("long"), F.lit(k).cast("long"), rate).alias("p")).first().p
    terms = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(rate) + (n - j) * math.log1p(-rate) for j in range(k + 1)]
    top = max(terms)
    assert got == pytest.approx(top + math.log(sum(math.exp(t - top) for t in terms)), rel=1e-9)


def labelled(spark, n, noisy):
    """Good texts; bad ones full of symbols; `noisy` good ones with a few symbols."""
    rng, rows, labels = random.Random(7), [], []
    for i in range(n):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(20)]
        bad = i % 5 == 0
        if bad:
            words = [w + "***" for w in words]
        elif i < noisy:
            words[0] += "*****"
        rows.append((i, " ".join(words), None if i % 3 else "x"))
        labels.append((i, 0 if bad else 1))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_hold_their_bound(spark):
    docs, labels = labelled(spark, 6000, 0)
    verdicts = rules.assess(docs, labels).join(labels, "doc_id")
    assert verdicts.filter("quality = 1 and not kept").count() == 0
    assert verdicts.filter("quality = 0 and kept").count() == 0  # both strata are certified
    docs, labels = labelled(spark, 6000, 3000)
    cutoffs = rules.certified_cutoffs(rules.features(docs, "doc_id", "lang"), labels, "lang")
    # Symbols of half the good texts: cutoffs below theirs cannot be certified.
    assert all(r.cutoff >= 3 for r in cutoffs.filter("metric = 'symbols'").collect())


def test_few_labels_certify_nothing(spark):
    docs, labels = labelled(spark, 300, 0)
    assert rules.certified_cutoffs(rules.features(docs, "doc_id", "lang"), labels, "lang").isEmpty()


def test_rules_on_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (6, None)], "doc_id long, quality int")
    rows = rules.assess(edge, labels).collect()
    assert len(rows) == len(EDGE_ROWS)
    assert all(not r.kept for r in rows if r.doc_id in (1, 2, 3, 4))
    kept = rules.keep_good(edge, labels)
    assert kept.columns == edge.columns
    assert by_id(kept, "doc_id", "text") == by_id(edge.filter("doc_id is null or doc_id in (6, 7, 8)"), "doc_id", "text")
    assert rules.assess(empty, labels).collect() == [] and rules.keep_good(empty, labels).collect() == []
    assert rules.keep_good(edge, labels.filter("false")).count() == kept.count()


def mixture(spark, n):
    rng = random.Random(8)
    rows = [(i, rng.choice(["t", None, "", "longer text"]), rng.choice(["hot"] * 4 + ["a", "b", None])) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("n, count", [(1000, 40), (997, 10), (7, 40), (1, 3)])
def test_shards_are_even_and_mixed(spark, monkeypatch, n, count):
    monkeypatch.setattr(shards, "BUCKET_ROWS", 37)
    docs = mixture(spark, n)
    rows = shards.interleave(docs, count).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == list(range(n))
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(count)) and max(sizes.values()) - min(sizes.get(s, 0) for s in range(count)) <= 1
    for s, size in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(size))
    assert all(r.size == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    for source, total in Counter(r.source for r in rows).items():
        share = [sum(r.source == source and r.shard == s for r in rows) for s in range(count)]
        assert max(share) - min(share) <= 2 + total / n


def test_bucket_size_does_not_change_the_result(spark, monkeypatch):
    docs = mixture(spark, 500)
    want = by_id(shards.interleave(docs, 8), "doc_id", "shard", "slot")
    monkeypatch.setattr(shards, "BUCKET_ROWS", 11)
    assert by_id(shards.interleave(docs, 8), "doc_id", "shard", "slot") == want


def test_shards_of_edge_rows(edge, empty):
    rows = shards.interleave(edge, 4).collect()
    assert len(rows) == len(EDGE_ROWS) and sorted((r.shard, r.slot) for r in rows) == sorted(set((r.shard, r.slot) for r in rows))
    assert shards.interleave(empty, 4).collect() == []


def test_written_shards(spark, tmp_path):
    docs = mixture(spark, 200).withColumn("shard_of", F.lit(1))
    shards.write_shards(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert by_id(back, *docs.columns) == by_id(docs, *docs.columns)
    assert {r["count"] for r in back.groupBy("shard").count().collect()} == {40}
