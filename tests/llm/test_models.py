"""Ordinal quality classifier and Pitman-Yor language model."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import EDGE_ROWS
from entidex.llm import pitman_yor as py
from entidex.llm import quality
from entidex.llm.common import scratch
from entidex.llm.queries import QUERIES
from pyspark.sql import functions as F


def test_grades_are_learnt_and_ordered(spark):
    """Held-out accuracy on the larger tables: a third of the labels is not trained on."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ratings = spark.read.parquet(f"{sf}/labels.parquet").withColumn("grade", quality.grade_of(F.col("quality"), F.col("toxic")))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3))
    model = quality.train(docs, ratings.filter(fold > 0))
    assert model.thresholds[0] < model.thresholds[1]
    held = ratings.filter(fold == 0)
    rows = quality.selected(quality.score(docs.join(held.select("doc_id"), "doc_id"), model)).join(held, "doc_id").collect()
    kept = {g: [r.kept for r in rows if r.grade == g] for g in (0, 1, 2)}
    assert sum(kept[2]) >= 0.98 * len(kept[2])
    assert sum(kept[0]) <= 0.1 * len(kept[0])
    mean = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in (0, 1, 2)]
    assert mean[0] < mean[1] < mean[2]


def test_gradient_leads_to_the_least_loss():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for i in range(300):
        grade = int(rng.integers(0, 3))
        rows.append(np.array([10 + grade] * 2 + list(rng.integers(100, 110, 5))))
        grades.append(grade)
    model = quality.fit(rows, np.array(grades))
    tails = model.tails(np.array([model.weights[r].sum() for r in rows]))
    assert ((tails > 0.5).sum(axis=1) == np.array(grades)).mean() > 0.98
    assert (tails[:, 0] >= tails[:, 1]).all()


def test_quality_of_edge_rows(spark, edge, empty):
    ratings = spark.createDataFrame([(6, 2), (6, 0), (7, 1), (None, 1), (8, None), (99, 2)], "doc_id long, grade int")
    model = quality.train(edge, ratings)
    rows = quality.score(edge, model).collect()
    assert len(rows) == len(EDGE_ROWS) and all(0 <= r.expected_grade <= 2 for r in rows)
    assert quality.score(empty, model).collect() == []
    blank = quality.train(edge, ratings.filter("false"))
    assert len({r.score for r in quality.score(edge, blank).collect()}) == 1


def test_sample_is_bounded_and_repeats(spark, edge, monkeypatch):
    monkeypatch.setattr(quality, "MOST_LABELLED", 2)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, grades: seen.append(len(rows)))
    ratings = spark.createDataFrame([(i, 1) for i in range(1, 9)], "doc_id long, grade int")
    quality.train(edge, ratings)
    assert seen[0] <= 2


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def plain(rows):
    """held_out, n_tokens, n_known, train_tokens and base_score of each row, by counting."""
    count = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    total, distinct = sum(count.values()), len(count)
    return [
        (i, held(i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), total, sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens(t)))
        for i, t in rows
    ]


def same(got, want):
    key = lambda r: (str(r[0]), r[2], r[5])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(a)[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def test_base_scores_match_counting(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op7_pitman_yor"](spark, sf_dir).collect()
    same(found, plain(rows))
    assert all(r.score < 0 for r in found)


def test_edge_rows(edge, empty):
    same(py.score_texts(edge).collect(), plain([r[:2] for r in EDGE_ROWS]))
    assert py.score_texts(empty).collect() == []


def words_and_rows(seed, n_rows=800):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(["the", "of", "a"], k=30) + [f"w{rng.randint(0, 300)}" for _ in range(20)])) for i in range(n_rows)]


def test_hot_words_and_partitions_score_alike(spark):
    """Neither whether a word's postings stay at the chunk nor the number of shards matters."""
    docs = spark.createDataFrame(words_and_rows(10), "doc_id long, text string").coalesce(2)
    rows = lambda: sorted((r.doc_id, round(r.score, 6), r.n_known, round(r.base_score, 6)) for r in py.score_texts(docs).collect())
    want = rows()
    assert not py.blocks(docs, "doc_id", "text", 8).filter("kind = 'hot'").isEmpty()
    spark.conf.set("spark.sql.shuffle.partitions", "60")  # too many shards for these few tokens to have hot words
    try:
        assert py.blocks(docs, "doc_id", "text", 60).filter("kind = 'hot'").isEmpty()
        cold = rows()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert cold == want


def plain_sampler(rows):
    """Scores by dishes in dictionaries, customers seated one by one, with the operator's own draws."""
    ids = lambda text: [*py.Shingler().words(text or "").tolist(), int(py.END)]
    classes = py.contexts_for(sum(len(t or "") for _, t in rows))
    class_of = lambda word: int(py.mixed(np.array([word], np.uint64))[0]) % classes
    tokens = [(i, [(w, class_of(p)) for w, p in zip(ids(t), [int(py.START), *ids(t)])]) for i, t in rows]
    counts = Counter(k for i, keys in tokens if not held(i) for k in keys)
    words, n_of = {w for w, _ in counts}, Counter()
    for (w, u), n in counts.items():
        n_of[u] += n
    ones, twos = (sum(n == x for n in counts.values()) for x in (1, 2))
    discount = lambda a, b: min(0.95, max(0.05, a / (a + 2 * b))) if a else 0.5
    d1, theta = discount(ones, twos), py.CONCENTRATION
    tables = dict.fromkeys(counts, 1)
    customers = Counter(w for w, _ in counts)
    d0 = discount(*(sum(n == x for n in customers.values()) for x in (1, 2)))
    roots, total = dict.fromkeys(customers, 1), Counter()
    u64 = lambda x: np.array([x % 2**64], np.uint64)

    def seated(n, a, d, seed):
        t = 1
        for i in range(1, n):
            t += bool(py.uniform(seed, i)[0] < a / (i - d * t + a))
        return t

    keys = {k for _, ks in tokens for k in ks}
    for number in range(py.SWEEPS + 1):
        of = Counter()
        for (w, u), t in tables.items():
            of[u] += t
        c, r = sum(customers.values()), sum(roots.values())
        base = (theta + d0 * r) / (len(words) + 1)
        parent = lambda w: (customers[w] - d0 * roots.get(w, 0) + base) / (theta + c)
        if number > py.BURN_IN:
            for w, u in keys:
                total[w, u] += (counts[w, u] - d1 * tables.get((w, u), 0) + (theta + d1 * of[u]) * parent(w)) / (theta + n_of[u])
        if number == py.SWEEPS:
            break
        turn = py.mixed(u64(number + 1))[0]
        a_of = {(w, u): (theta + d1 * of[u]) * parent(w) for w, u in counts}
        tables = {(w, u): seated(n, a_of[w, u], d1, py.mixed((py.mixed(u64(w)) + py.mixed(u64(u + py.SEED))) ^ turn)) for (w, u), n in counts.items()}
        customers = Counter()
        for (w, _), t in tables.items():
            customers[w] += t
        roots = {w: seated(n, base, d0, py.mixed(u64(w) ^ turn)) for w, n in customers.items()}
    return {i: sum(math.log10(total[k] / (py.SWEEPS - py.BURN_IN)) for k in ks) for i, ks in tokens}


def test_scores_like_a_plain_sampler(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(40)], k=rng.randint(0, 25)))) for i in range(60)] + [(60, None), (61, "unknown words w1")]
    got = {r.doc_id: r.score for r in py.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_sampler(rows)
    assert set(got) == set(want)
    for i in got:
        assert got[i] == pytest.approx(want[i], rel=1e-9)


def test_contexts_grow_with_the_text():
    assert [py.contexts_for(n) for n in (0, 10_000, 2_400_000, 24_000_000, 10**13)] == [256, 256, 65_536, 524_288, py.MOST_CONTEXTS]


def test_seating_follows_the_process():
    """Mean number of tables against one-by-one seating, below and above the blocks."""
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**64, 400, np.uint64)
    for n, a, d in ((2, 0.5, 0.5), (40, 0.3, 0.7), (3000, 0.8, 0.6)):
        got = py.seat(np.full(400, n), np.full(400, a), d, seeds)
        want = []
        for _ in range(200):
            t = 1
            for i in range(1, n):
                t += rng.random() < a / (i - d * t + a)
            want.append(t)
        assert got.min() >= 1 and got.max() <= n
        assert got.mean() == pytest.approx(np.mean(want), rel=0.12)
    assert py.seat(np.array([0, 1]), np.array([1.0, 1.0]), 0.5, seeds[:2]).tolist() == [0, 1]


@pytest.mark.parametrize("at_once", [1, 7, py.DRAWS])
def test_draws_do_not_depend_on_how_many_are_made_at_once(monkeypatch, at_once):
    monkeypatch.setattr(py, "DRAWS", at_once)
    seeds, draws, chance = np.arange(5, dtype=np.uint64), np.array([1, 9, 30, 2, 8]), np.array([0.5, 0.2, 0.7, 1.0, 0.0])
    want = [sum(bool(py.uniform(seeds[i : i + 1], 100 + j)[0] < chance[i]) for j in range(draws[i])) for i in range(5)]
    assert py.successes(seeds, 100, draws, chance).tolist() == want


def test_probabilities_sum_to_one(spark):
    """Over the whole vocabulary and the unknown word, for every context."""
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(12)], k=40))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    stored = py.written(py.merged(py.blocks(docs, "doc_id", "text", 4).repartitionById(4, F.col("shard"))), scratch(spark), "shards")
    model, history = py.fitted(stored, 256)
    sums = Counter()
    for r in stored.filter("kind = 'shard'").collect():
        shard = py.Shard(*(bytes(r[c]) for c in py._MODEL_COLUMNS), model)
        for s in range(1, len(history)):
            shard.sweep(s, history[s - 1])
        parent = shard.parent(history[-1])
        theta, tokens_of = py.CONCENTRATION, np.array(model["C"], float)
        tables = np.array(history[-1][:256], float)
        back = (theta + model["d1"] * tables) / (theta + tokens_of)
        for c in np.flatnonzero(tokens_of):
            sums[c] += back[c] * parent.sum()
        own = shard.probabilities(history[-1]) - back[shard.contexts] * parent[shard.word_of]
        for c, p in zip(shard.contexts.tolist(), own.tolist()):
            sums[c] += p if tokens_of[c] else 0
    unknown = (theta + model["d0"] * history[-1][-1]) / (model["V"] + 1) / (theta + history[-1][-2])
    for c in np.flatnonzero(tokens_of):
        assert sums[c] + back[c] * unknown == pytest.approx(1, abs=1e-9)


def test_model_beats_its_base_on_held_out_texts(spark):
    scored = QUERIES["op7_pitman_yor"](spark, "/root/testdata/sf0.01")
    rows = scored.filter("held_out").collect()
    assert len(rows) > 50
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    both = {r.held_out: r.perplexity for r in py.perplexity(scored).collect()}
    assert both[False] < both[True]


def test_words_of_many_texts_at_once_are_those_of_each():
    strange = ["", None, " \t\n ", "One oNE one", "a\x0bb\x0cc\rd\x00e\x1cf\x85g\u00a0h \U0001f600 \u6f22\u5b57 \udc80", "end ", " start", "ÄÖ Äö"]
    for texts in (strange, strange[::-1], [""], [None, ""], [" "], ["x"]):
        hashes, place, lengths = py.Shingler.places(texts)
        want = [py.Shingler().words(t or "").tolist() for t in texts]
        assert lengths.tolist() == [len(w) for w in want]
        assert hashes[place].tolist() == sum(want, [])
        assert len(hashes) == len(set(hashes.tolist()))


@pytest.mark.parametrize("most", [5, 2**32 - 1])
def test_keys_are_ordered_alike_whatever_their_numbers(most):
    rng = np.random.default_rng(5)
    number, contexts = rng.integers(0, 4, 300) * (2**40 if most > 5 else 1), rng.integers(0, 5, 300).astype(np.uint32)
    contexts[7] = most
    order, first = py.ordered(number, contexts)
    want = sorted(range(300), key=lambda i: (number[i], contexts[i], i))
    assert order.tolist() == want
    keys = [(number[i], contexts[i]) for i in want]
    assert first.tolist() == [i == 0 or keys[i] != keys[i - 1] for i in range(300)]


def shard_of(n_words=50, n_contexts=400, seed=8):
    """A shard's columns, its model, and the totals of its first seating and three sweeps."""
    rng = np.random.default_rng(seed)
    per_word = rng.integers(1, 120, n_words)
    contexts = np.concatenate([np.sort(rng.choice(n_contexts, n, replace=False)) for n in per_word])
    counts = np.where(rng.random(len(contexts)) < 0.1, rng.integers(0, 300, len(contexts)), 1)
    words = np.sort(rng.integers(0, 2**64, n_words, np.uint64))
    columns = [py.packed(v, k) for v, k in ((words, np.uint64), (per_word, np.uint32), (contexts, np.uint32), (counts, np.int64))]
    model = {"V": n_words, "N": int(counts.sum()), "d1": 0.7, "d0": 0.4, "C": np.bincount(contexts, counts, n_contexts)}
    history, shard = [], py.Shard(*columns, model)
    for number in range(4):
        if number:
            shard.sweep(number, history[-1])
        history.append(np.zeros(n_contexts + 2, np.int64))
        shard.add_totals(history[-1])
    return columns, model, history, words


def test_words_alone_are_seated_as_among_all():
    """Frequent words are replayed by themselves, not with their whole shard."""
    columns, model, history, words = shard_of()
    shard = py.Shard(*columns, model)
    every = shard.averaged(history)
    wanted = words[[3, 20, 49]]
    alone = py.Shard(*columns, model, wanted)
    assert alone.words.tolist() == wanted.tolist()
    own = np.isin(shard.words[shard.word_of], wanted)
    assert alone.averaged(history).tolist() == every[own].tolist()
    assert alone.contexts.tolist() == shard.contexts[own].tolist()
    assert alone.word_count.tolist() == shard.word_count[[3, 20, 49]].tolist()


def test_sweeps_work_on_keys_of_several_customers_alone(monkeypatch):
    """Seeds are hashed for the draws that are made, not for each key that keeps its one table."""
    columns, model, history, words = shard_of()
    shard, hashed, drawn, mixed, uniform = py.Shard(*columns, model), [], [], py.mixed, py.uniform
    monkeypatch.setattr(py, "mixed", lambda x: hashed.append(len(x)) or mixed(x))
    monkeypatch.setattr(py, "uniform", lambda seeds, numbers: drawn.append(len(seeds)) or uniform(seeds, numbers))
    shard.sweep(1, history[0])
    several = int((shard.counts > 1).sum())
    assert 0 < several < len(shard.counts) / 5
    assert sum(hashed) - sum(drawn) <= several + len(words) + 1
