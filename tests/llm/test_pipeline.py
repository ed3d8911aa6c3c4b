"""The pipeline, stage by stage against brute force, and on awkward input."""

import corpus_pipeline
import oracle
import pytest
from conftest_llm import by_id
from entidex.llm import pii
from entidex.llm.common import scratch, written
from entidex.llm.queries import SQL
from test_bpe import expected
from test_decontamination import plain as found_in
from test_jaccard import plain as components
from test_spans import in_order, plain_personal

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage makes of all its predecessor kept."""
    folder, docs, out = scratch(spark), spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, str(i))
        out.append(docs)
    return [frame.collect() for frame in out]


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "BPE encoding and decoding"]


def rows(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame)


def test_rejected_documents_go(stages, sf_dir):
    verdicts = oracle.connect(sf_dir).execute(f"select doc_id, kept from ({SQL['op9_quality_rules']})").fetchall()
    kept = {i for i, ok in verdicts if ok}
    assert 0 < len(kept) < len(verdicts)
    assert rows(stages[1]) == [r for r in rows(stages[0]) if r[0] in kept]


def test_one_of_each_group_stays(stages):
    first = {c for _, _, c in components([(r.doc_id, r.text) for r in stages[1]])}
    assert len(first) < len(stages[1])
    assert rows(stages[2]) == [r for r in rows(stages[1]) if r[0] in first]


def test_contaminated_documents_go(stages, spark, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r for r in rows(stages[2]) if not found_in(r[1], items)[1]]
    assert 0 < len(clean) < len(stages[2])
    assert rows(stages[3]) == clean


def test_personal_data_is_replaced(stages):
    """No term recurs often enough here to reveal anyone, so the patterns alone decide."""
    changed = 0
    for before, after in zip(rows(stages[3]), rows(stages[4])):
        text = pii.redact(before[1], in_order(plain_personal(before[1]), pii.KINDS))
        changed += text != before[1]
        assert after == (before[0], text, *before[2:4], len(text))
    assert changed


def test_tokens_are_those_of_the_library(stages):
    texts = {r.doc_id: r.text for r in stages[4]}
    assert sorted(r.doc_id for r in stages[5]) == sorted(texts)
    for r in stages[5]:
        assert (r.ids, r.text) == expected(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert by_id(corpus_pipeline.run(spark, sf_dir), "doc_id", "n_tokens") == by_id(spark.createDataFrame(stages[5]), "doc_id", "n_tokens")


@pytest.mark.parametrize("which", ["edge", "empty"])
def test_awkward_rows(spark, sf_dir, request, which):
    docs = request.getfixturevalue(which).select(*COLUMNS)
    folder = scratch(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, sf_dir)
        if i < 4:
            assert made.columns == COLUMNS and [f.dataType for f in made.schema] == [f.dataType for f in docs.schema]
        docs = written(made, folder, str(i))
    found = {r.doc_id: r.text for r in docs.collect()}
    if which == "empty":
        assert found == {}
    else:
        # Of the documents with enough words: the one that only repeats itself goes, one of two equal rows stays.
        assert set(found) == {None, 6, 7, 8} and docs.filter("doc_id = 6").count() == 1
