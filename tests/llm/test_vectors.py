"""Clusters and codes of vectors: against loops over all vectors, entries and components."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from conftest_llm import CLASHING

from entidex.llm import clusters, codes
from entidex.llm.vectors import MOST, narrow, squared_distances, wide

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(n, seed=3, components=8, kinds=None):
    """Rounded numbers, so that distances tie; labels and some ids are null."""
    rng = random.Random(seed)
    pool = [[rng.randint(-12, 12) / 8 for _ in range(components)] for _ in range(kinds or n)]
    return [(i, rng.choice(pool), rng.choice([None, 1, 2])) for i in range(n)]


BAD = [(900, None, 1), (901, [None] * 8, 1), (902, [0.0] * 7, 1), (903, [0.0] * 9, 1), (904, [], 1), (905, [float("nan")] + [0.0] * 7, 1), (906, [float("-inf")] + [0.0] * 7, 1)]


def frame_of(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for name in (*CLASHING, "tile", "block", "n", "values", "cluster", "distance", "position", "entry", "code", "error", "vector", "of_label", "a.b"):
        frame = frame.withColumn(name, frame.vec_id)
    return frame


def whole(rows, scale, components=8):
    return [(i, [min(MOST, max(-MOST, math.floor(scale * x))) for x in v], label) for i, v, label in rows if v is not None and len(v) == components and None not in v and all(map(math.isfinite, v))]


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def plain_clusters(rows, k, rounds):
    kept = whole(rows, clusters.SCALE)
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(r[1]) for r in order[:k]]
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        chosen = [nearest(r[1]) for r in kept]
        for c in range(len(centroids)):
            own = [r[1] for r, x in zip(kept, chosen) if x == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    return [(r[0], nearest(r[1]), far(r[1], centroids[nearest(r[1])])) for r in kept], centroids


@pytest.mark.parametrize(("rows", "k", "width"), [(vectors(300) + BAD, 16, 4), (vectors(300) + BAD, 16, 3), (vectors(2500, kinds=9), 5, 8), (vectors(4), 16, 32), (vectors(40) + vectors(40, seed=8) + [(None, [0.5] * 8, None)], 7, 2)])
def test_clusters_like_a_plain_loop(spark, rows, k, width):
    found, centroids = clusters.cluster(frame_of(spark, rows), components=8, clusters=k, width=width)
    want, centres = plain_clusters(rows, k, 3)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    assert centroids.tolist() == centres


def test_inertia_and_digest(spark):
    rows = vectors(60)
    got = clusters.with_inertia(*clusters.cluster(frame_of(spark, rows), components=8, clusters=4)).collect()
    want, centres = plain_clusters(rows, 4, 3)
    assert {(r["vec_id"], r["cluster"], r["distance"]) for r in got} == set(want)
    assert {r["inertia"] for r in got} == {sum(w[2] for w in want)}
    for r in got:
        assert r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_clusters_of_a_tile_of_equal_vectors_and_of_huge_numbers(spark):
    rows = [(i, [0.25] * 8, None) for i in range(3000)] + [(5000, [3e38] * 8, 1), (5001, [-3e38] * 8, 1)]
    found, centroids = clusters.cluster(frame_of(spark, rows, 1), components=8, clusters=3)
    want, centres = plain_clusters(rows, 3, 3)
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert centroids.tolist() == centres


def test_nothing_kept(spark):
    for rows in (BAD, []):
        frame = frame_of(spark, rows)
        found, centroids = clusters.cluster(frame, components=8)
        assert found.count() == 0 and len(centroids) == 0
        assert clusters.with_inertia(found, centroids).count() == 0
        books = codes.train(frame, components=8)
        assert books.shape == (4, 0, 2)
        assert codes.encode(frame, books).count() == 0


def plain_codes(rows, parts, entries, rounds, components=8):
    kept, width = whole(rows, codes.SCALE), components // parts
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(r[1], p) for r in order[:entries]] for p in range(parts)]
    nearest = lambda v, p: min(range(len(books[p])), key=lambda e: (far(v, books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            chosen = [nearest(cut(r[1], p), p) for r in kept]
            for e in range(len(books[p])):
                own = [cut(r[1], p) for r, x in zip(kept, chosen) if x == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    out = []
    for i, v, label in kept:
        code = [nearest(cut(v, p), p) for p in range(parts)]
        out.append((i, label, code, sum(far(cut(v, p), books[p][code[p]]) for p in range(parts))))
    return out, books


@pytest.mark.parametrize(("rows", "parts", "entries"), [(vectors(300) + BAD, 4, 40), (vectors(300) + BAD, 2, 16), (vectors(900, kinds=7), 4, 20), (vectors(5), 4, 256), (vectors(30) + vectors(30, seed=9) + [(None, [0.5] * 8, None)], 1, 10)])
def test_codes_like_a_plain_loop(spark, rows, parts, entries):
    frame = frame_of(spark, rows)
    books = codes.train(frame, components=8, parts=parts, entries=entries)
    want, plain = plain_codes(rows, parts, entries, codes.ROUNDS)
    assert books.tolist() == plain
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0, r[2:])
    got = [(r["vec_id"], r["label"], list(r["code"]), r["error"]) for r in codes.encode(frame, books).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_label_error_and_decoding(spark):
    rows = vectors(80) + BAD
    frame = frame_of(spark, rows)
    books = codes.train(frame, components=8, entries=30)
    coded = codes.encode(frame, books).cache()
    want, plain = plain_codes(rows, 4, 30, codes.ROUNDS)
    for r in codes.with_label_error(coded).collect():
        assert r["label_error"] == sum(w[3] for w in want if w[1] == r["label"])
    code_of = {r["vec_id"]: r["code"] for r in coded.collect()}
    for r in codes.decode(coded, books).collect():
        assert r["vector"] == [x / codes.SCALE for p, e in enumerate(code_of[r["vec_id"]]) for x in plain[p][e]]
    assert codes.codebook_digest(books) == hashlib.sha256(",".join(str(x) for b in plain for e in b for x in e).encode()).hexdigest()


def test_unequal_parts_are_refused(spark):
    with pytest.raises(ValueError):
        codes.train(frame_of(spark, vectors(3)), components=8, parts=3)


@pytest.mark.parametrize("alphabet", [2, 5, 1000])
@pytest.mark.parametrize("leaves", [1, 7, codes.LEAVES])
def test_walk_meets_every_part_once(monkeypatch, alphabet, leaves):
    """Shared prefixes change no distance, however deep the branches are."""
    monkeypatch.setattr(codes, "LEAVES", leaves)
    rng = np.random.default_rng(alphabet)
    rows, _ = codes.distinct_rows(rng.integers(-alphabet, alphabet, (400, 6)))
    entries = rng.integers(-alphabet, alphabet, (9, 6))
    met = {}

    def leaf(places, best, distance):
        assert len(places) < 2 * leaves
        for p, b, d in zip(places.tolist(), best.tolist(), distance.tolist()):
            assert p not in met
            met[p] = (b, d)

    codes.walk(rows, entries, leaf)
    all_of = ((rows[:, None] - entries[None]) ** 2).sum(2)
    assert met == {i: (int(d.argmin()), int(d.min())) for i, d in enumerate(all_of)}


def test_keys_sort_like_their_integers():
    rng = np.random.default_rng(1)
    rows, place = codes.distinct_rows(rng.integers(-300, 300, (500, 3)))
    keys = codes.keys_of(rows).tolist()
    assert keys == sorted(keys) and len(set(keys)) == len(rows)
    import pyarrow as pa

    assert (codes.parts_of(pa.array(keys, pa.binary()), 3) == rows).all()


def test_distances_are_exact_for_large_numbers():
    a, b = np.array([[MOST, -MOST, 5]]), np.array([[-MOST, MOST, 4], [MOST, -MOST, 4]])
    assert squared_distances(a, b).tolist() == [[8 * MOST * MOST + 1, 1]]
    for values in (np.array([[1, -200], [3, 70_000]]), np.array([[MOST * MOST * 8]]), np.zeros((0, 2), np.int64)):
        data, kind = narrow(values)
        assert (wide(data, kind, values.shape[1]) == values).all()
