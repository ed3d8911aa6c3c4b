import hashlib
import random

import public_tokenizers
from conftest_llm import EDGE_ROWS, by_id
from entidex.llm import bpe
from entidex.llm.queries import QUERIES, tokenizer_path
from tokenizers import Tokenizer

PATH = tokenizer_path()
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def test_random_texts_match_the_library():
    rng = random.Random(3)
    letters = "ab  \n\t'sédßñ漢字²½٣  \x1c\x85​😀<|endoftext|>0129!,.’ ́ "
    codec = bpe.codec(PATH)
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.1:
            text += "<|endoftext|>" + text[::-1]
        ids = codec.encode(text)
        assert (ids, codec.decode(ids)) == expected(text)


def test_scan_and_heap_give_the_same_parts():
    codec, rng = bpe.codec(PATH), random.Random(4)
    for n in (2, 5, 63, 64, 65, 500):
        word = bytes(rng.choice(b"theinger\xc3\xa9") for _ in range(n))
        parts = [codec.first[b] for b in word]
        assert codec._scan(list(parts)) == codec._heap(list(parts))


def test_kept_words_stay_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 10)
    codec = bpe.Codec(PATH)
    text = " ".join(f"word{i} again" for i in range(100))
    assert codec.encode(text) == expected(text)[0]
    assert len(codec.kept) <= 10 and len(codec.older) <= 10


def test_edge_rows(edge):
    got = by_id(bpe.encode(edge, PATH), "doc_id", "ids", "decoded")
    want = [(i, *expected(t)) for i, t, *_ in EDGE_ROWS]
    assert got == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_decode_of_stored_ids(edge):
    encoded = bpe.encode(edge, PATH)
    again = bpe.decode(encoded.select("doc_id", "ids"), PATH)
    assert by_id(again, "doc_id", "decoded") == by_id(encoded, "doc_id", "decoded")


def test_empty_table(empty):
    assert bpe.encode(empty, PATH).collect() == []


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op4_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids, text = expected(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(text))
