import random
import re

import oracle
import pytest
from conftest_llm import EDGE_ROWS, by_id
from entidex.llm import decontamination as dec
from entidex.llm.queries import QUERIES, SQL


def test_twin(spark, sf_dir):
    assert oracle.differences(QUERIES["op6_decontamination"](spark, sf_dir), SQL["op6_decontamination"], oracle.connect(sf_dir)) is None


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(text, items):
    w, hit, found = words(text), set(), set()
    for item, item_text in items:
        iw = words(item_text)
        size = min(10, len(iw))
        windows = {tuple(iw[i : i + size]) for i in range(len(iw) - size + 1)} if size else set()
        for p in range(len(w) - size + 1):
            if size and tuple(w[p : p + size]) in windows:
                hit |= set(range(p, p + size))
                found.add(item)
    return len(w), len(hit), sorted((i for i in found if i is not None), key=str)


def cases():
    rng = random.Random(9)
    few = ["a", "b", "c", "É", "x1"]
    items = [(i, " ".join(rng.choices(few, k=rng.randint(0, 25)))) for i in range(25)] + [(3, "a b c"), (None, "c c c c c c c c c c c"), (30, None)]
    docs = [(i, " ".join(rng.choices([*few, "B-a", "C."], k=rng.randint(0, 60)))) for i in range(150)]
    return docs + [(5, "a b c"), (None, "A, b; C!"), (200, None), (201, "")], items


@pytest.mark.parametrize("block_chars, candidates", [(10**6, 10**6), (60, 50)])
def test_matches_brute_force(spark, monkeypatch, block_chars, candidates):
    monkeypatch.setattr(dec, "CANDIDATES", candidates)
    docs, items = cases()
    found = dec.phrase_matches(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), block_chars=block_chars,
    ).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, sorted(r["items"], key=str)) for r in found)
    assert got == sorted((str(i), *plain(t, items)) for i, t in docs)


def test_ranges_stay_in_their_document(spark):
    phrase = " ".join(f"w{i}" for i in range(10))
    docs = spark.createDataFrame([(1, phrase), (2, phrase + " w9"), (3, "w0 w1 w2 w3 w4"), (4, "w5 w6 w7 w8 w9")], "doc_id long, text string").coalesce(1)
    rows = dec.phrase_matches(docs, spark.createDataFrame([(1, phrase)], "item_id long, text string")).collect()
    assert {r.doc_id: [tuple(h) for h in r.hits] for r in rows} == {1: [(0, 10)], 2: [(0, 10)], 3: [], 4: []}


def test_proximity(spark, tmp_path):
    docs = spark.createDataFrame([(1, "red big old car"), (2, "red x x x x x car"), (3, "car"), (4, "car red"), (5, None)], "doc_id long, text string").coalesce(1)
    index = dec.build_index(docs)
    found = dec.proximity_matches(index, [(1, [b"red", b"car"]), (2, [b"car"]), (3, [b"car", b"zebra"])], 4)
    assert by_id(found, "query", "id") == [(1, 1), (1, 4), (2, 1), (2, 2), (2, 3), (2, 4)]


def test_edge_rows(spark, edge, empty):
    items = spark.createDataFrame([(1, "the same row twice in the table with enough words to count"), (2, None), (3, "")], "item_id long, text string")
    rows = dec.phrase_matches(edge, items).collect()
    assert len(rows) == len(EDGE_ROWS) and sorted(r.doc_id for r in rows if r.n_hit) == [6, 6]
    assert dec.phrase_matches(empty, items).collect() == []
    assert all(r.n_hit == 0 for r in dec.phrase_matches(edge, items.filter("false")).collect())
    clean = dec.drop_contaminated(edge, items)
    assert by_id(clean, *edge.columns) == by_id(edge.filter("doc_id is null or doc_id != 6"), *edge.columns)
