import random

import numpy as np
import oracle
import pytest
from conftest_llm import EDGE_ROWS, by_id
from entidex.llm import jaccard
from entidex.llm.queries import QUERIES, SQL


def test_twin(spark, sf_dir):
    assert oracle.differences(QUERIES["op2_jaccard_join"](spark, sf_dir), SQL["op2_jaccard_join"], oracle.connect(sf_dir)) is None


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(rows):
    """Component of each row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, len(s), least[root(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


def family(rng, size, edits, copies):
    """Copies of a text, each with some words changed: distances around the threshold."""
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(size)] = f"w{rng.randint(0, 10**6)}"
        out.append(" ".join(text))
    return out


def corpus(seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for size in (1, 3, 4, 5, 6, 8, 9, 10, 12, 15, 20, 30, 33, 50, 90, 200):
        for _ in range(4):
            texts += family(rng, size, max(1, size // 25), rng.randint(1, 6))
    texts += family(rng, 60, 3, 60)  # a hub: many around one, not all linked to each other
    for n in (5, 10, 20, 60):  # one passage in many texts
        texts += [" ".join(passage + [f"w{rng.randint(0, 10**6)}" for _ in range(n)]) for _ in range(15)]
    texts += [texts[0]] * 5 + ["", " ", None] * 2
    # A chain, each text a little further on.
    words = [f"c{i}" for i in range(300)]
    texts += [" ".join(words[i : i + 100]) for i in range(0, 120, 5)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, block, pivots", [(1, 1_000_000, 4), (2, 300, 4), (3, 2000, 1)])
def test_matches_brute_force(spark, monkeypatch, seed, block, pivots):
    """Areas whole, and areas cut by pivots and windows."""
    monkeypatch.setattr(jaccard, "AREA", block)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard, "PARTNERS", 7)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert by_id_int(jaccard.join_texts(docs)) == plain(rows)


def by_id_int(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect())


def test_texts_of_one_block_travel_once(spark, monkeypatch):
    """What pivots leave outside meets the others in one place where the area fits into one."""
    sent = {}
    compared = jaccard.compared_blocks

    def recorded(docs, text_col, nodes, targets, folder, name):
        sent[name] = targets.groupBy("node").count().collect()
        return compared(docs, text_col, nodes, targets, folder, name)

    monkeypatch.setattr(jaccard, "compared_blocks", recorded)
    monkeypatch.setattr(jaccard, "AREA", 1000)
    rng = random.Random(7)
    words = [f"h{i}" for i in range(60)]
    # Sizes of one class and distances of several bands from any of them.
    texts = [" ".join(words[i : i + 50] + [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice((1, 2, 12)))]) for i in (0, 2, 4, 6, 8, 10) for _ in range(12)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id_int(jaccard.join_texts(docs)) == plain(rows)
    assert sent["large"] and {r["count"] for r in sent["large"]} == {1}


def test_a_common_passage_makes_no_large_area(spark, monkeypatch):
    """Pairs of near copies that all quote one passage are compared pair by pair."""
    sent = {}
    compared = jaccard.compared_blocks

    def recorded(docs, text_col, nodes, targets, folder, name):
        sent[name] = sorted(r["count"] for r in targets.groupBy("g").count().collect())
        return compared(docs, text_col, nodes, targets, folder, name)

    monkeypatch.setattr(jaccard, "compared_blocks", recorded)
    monkeypatch.setattr(jaccard, "AREA", 1000)
    rng = random.Random(11)
    passage, texts = [f"p{i}" for i in range(100)], []
    for _ in range(40):
        own = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
        texts += [" ".join(passage + own), " ".join(passage + own + ["x"])]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert by_id_int(jaccard.join_texts(docs)) == plain(rows)
    assert sent == {"small": [2] * 40}


@pytest.mark.parametrize("seed", [12, 13])
def test_linked_sets_keep_a_common_region(spark, tmp_path, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    found = jaccard.surveyed(docs, "id", "text", 5).filter("region is not null").select("region", "ring", "node", "least")
    regions = {}
    for r in jaccard.viable(found, str(tmp_path)).collect():
        regions.setdefault(r.node, set()).add(r.region)
    sets = {jaccard.name_of(s): s for s in (jaccard.Shingler().set_of(t) for _, t in rows) if len(s)}
    linked = 0
    for a, x in sets.items():
        for b, y in sets.items():
            both = len(np.intersect1d(x, y, assume_unique=True))
            if a < b and 100 * both >= 80 * (len(x) + len(y) - both):
                linked += 1
                assert regions[a] & regions[b]
    assert linked > 50


@pytest.mark.parametrize("least", [2, 16, 10**9])
def test_frequent_shingles_are_counted_too(monkeypatch, least):
    """Counts by matrices, by both ways and by merged lists hold the same sets together."""
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", least)
    monkeypatch.setattr(jaccard, "COUNTS", 700)
    rng = random.Random(14)
    texts = [t for size, edits in ((60, 5), (200, 6), (30, 3)) for t in family(rng, size, edits, 40)] + family(rng, 12, 1, 3)
    sets = [(i, i, jaccard.Shingler().set_of(t)) for i, t in enumerate(texts)]
    for left, right in ((sets, sets), (sets[::2], sets[1::2]), (sets[:1], sets[120:])):
        meets = {(x, y) for x, _, a in left for y, _, b in right if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))}
        found = jaccard.links_within(left, right)
        assert set(found) <= meets
        joined = lambda pairs: groups(len(sets), pairs)
        assert joined(found) == joined(meets)


def groups(n, pairs):
    """Least member of the group of each of n items under the pairs."""
    least = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize("seed", [8, 9])
def test_windows_of_sizes_and_distances_lose_no_link(spark, monkeypatch, seed):
    """Links across cells, cut and packed, with no pivot after the first."""
    monkeypatch.setattr(jaccard, "AREA", 100)
    monkeypatch.setattr(jaccard, "BLOCK", 400)
    monkeypatch.setattr(jaccard, "PROGRESS", 0.0)
    rng = random.Random(seed)
    hub = [f"h{i}" for i in range(100)]
    texts = []
    for _ in range(25):
        start = rng.randint(0, 40)
        base = hub[start : start + rng.randint(10, 60)] + [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 60))]
        texts += [" ".join(base + [f"x{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, len(base) // 4))]) for _ in range(4)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert by_id_int(jaccard.join_texts(docs)) == plain(rows)


def test_one_reading_describes_and_signs(spark):
    """Documents and the slices that sets share come from one reading of the texts."""
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    rows = [("a", text("a", 40)), ("b", text("a", 40) + " z"), ("b", text("b", 30)), (None, text("b", 30)), ("c", " "), ("d", None), ("e", "one two")]
    docs = spark.createDataFrame(rows, "name string, body string").repartition(2)
    found = jaccard.surveyed(docs, "name", "body", 5).collect()
    described = sorted(((r.id, r.n_shingles) for r in found if r.region is None), key=str)
    assert described == sorted(((i, len(shingles(t))) for i, t in rows), key=str)
    assert all((r.node is None) == (r.n_shingles == 0) for r in found if r.region is None)
    names = {jaccard.name_of(jaccard.Shingler().set_of(t)) for _, t in rows[:2]}
    members = [r for r in found if r.region is not None]
    assert {r.node for r in members} == names and all(r.id is None for r in members)
    a, b = ({x: np.unique(made.astype(np.uint32)) for x, _, made in jaccard.signatures(jaccard.Shingler().set_of(t))} for _, t in rows[:2])
    assert len(members) == 2 * sum(len(np.intersect1d(a[x], b[x])) for x in a.keys() & b.keys())


def test_joins_by_shuffle_too(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SENT_ROWS", 0)
    rows = corpus(4)[:150]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id_int(jaccard.join_texts(docs)) == plain(rows)


def test_four_against_five_shingles(spark):
    """The smallest sets that link without being equal, alone and as the middle of a chain."""
    word = [f"s{i}" for i in range(40)]
    texts = [" ".join(word[:8]), " ".join(word[:9]), " ".join(word[10:17]), " ".join(word[10:18])]
    texts += [" ".join(word[20:29]), " ".join(word[20:28]), " ".join(["x", *word[20:28]]), " ".join(word[30:39]), " ".join([*word[30:38], "y", "z"])]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id_int(jaccard.join_texts(docs)) == plain(rows)
    assert [c for _, _, c in plain(rows)] == [0, 0, 2, 3, 4, 4, 4, 7, 8]


def test_linked_sets_share_enough_slices():
    """The bound behind the regions, on random pairs at every size."""
    rng = np.random.default_rng(5)
    for size in [*range(5, 60), 100, 333, 1000]:
        for _ in range(12):
            universe = rng.integers(0, 2**63, 2 * size + 20).astype(np.uint64)
            a = universe[:size]
            gone, new = int(rng.integers(0, size // 9 + 2)), int(rng.integers(0, size // 5 + 2))
            b = np.concatenate([a[gone:], universe[size : size + new]])
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both) or len(b) < 5:
                continue
            left = {ring: (least, set(made.tolist())) for ring, least, made in jaccard.signatures(np.sort(a))}
            right = {ring: (least, set(made.tolist())) for ring, least, made in jaccard.signatures(np.sort(b))}
            if set(a.tolist()) != set(b.tolist()):
                assert any(len(left[r][1] & right[r][1]) >= max(left[r][0], right[r][0]) for r in left.keys() & right.keys()), (len(a), len(b), both)


def test_edge_rows(edge, empty):
    rows = by_id(jaccard.join_texts(edge), "doc_id", "n_shingles", "component_id")
    assert len(rows) == len(EDGE_ROWS)
    assert rows[0][0] is None and rows[0][2] is None
    assert [r for r in rows if r[0] in (1, 2, 3, 4)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4)]
    assert jaccard.join_texts(empty).collect() == []
    kept = jaccard.keep_one(edge)
    assert kept.columns == edge.columns and kept.count() == len(EDGE_ROWS) - 1


def test_one_of_each_group_stays(spark):
    rows = corpus(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in jaccard.keep_one(docs).collect()) == sorted({c for _, _, c in plain(rows)})


def test_repeated_ids_with_different_texts(spark):
    """A text goes with its own group, not with another text of its id."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(20))
    rows = [(1, text("a")), (2, text("a")), (2, text("b")), (3, text("b")), (4, text("c")), (4, text("c") + " and"), (None, text("a")), (5, None), (5, text("d"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = by_id(jaccard.keep_one(docs), "doc_id", "text")
    assert [r for r in kept if r[0] != 4] == [(None, text("a")), (1, text("a")), (2, text("b")), (5, None), (5, text("d"))]
    assert sum(r[0] == 4 for r in kept) == 1
