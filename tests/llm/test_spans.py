"""Secret scan and personal data."""

import hashlib
import random
import re
import time
import tracemalloc

import pytest
from conftest_llm import EDGE_ROWS, by_id
from entidex.llm import pii, secrets
from entidex.llm.queries import QUERIES


def luhn(digits):
    odd = [int(d) for d in digits[-1::-2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def plain_secrets(text):
    out = [("assign", *m.span()) for m in re.finditer(r"""(?ia:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 8]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return out + [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]


def plain_personal(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    cards = [(m, re.sub(r"[\x20-]", "", m[0])) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)]
    out += [("card", *m.span()) for m, d in cards if 12 <= len(d) <= 19 and luhn(d)]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]


def in_order(spans, kinds):
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


@pytest.mark.parametrize("module, plain, letters", [
    (secrets, plain_secrets, ["token", "API_key", "password", '"', "'", " ", "=", ":", "abc123XY", "AKIA", "ABCD1234EFGH", "0123456789abcdef", "é", "\n", "K", "ſecret", "."]),
    (pii, plain_personal, ["a", "b.c", "@", "@x.org", ".", "-", " ", "1", "23", "255", "300", "+49", "(0)", "4539 1488 0343 6467", "4539148803436467", "é", "٣", "\n"]),
])
def test_random_texts(module, plain, letters):
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        assert in_order(module.base_spans(text), module.KINDS) == in_order(plain(text), module.KINDS), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1 " * 100_000, "token=" * 50_000, "AKIA" * 50_000):
        pii.base_spans(text)
        secrets.scan(text)


def plain_tokens(text):
    """Kind, token and start, character by character; a literal is looked for from each quote anew."""
    out, at = [], 0
    while at < len(text):
        c, start, before = text[at], at, text[at - 1] if at else "\n"
        kind = "other"
        if c in " \t":
            at += 1
            continue
        if (text.startswith("//", at) and before != ":") or (c == "#" and (before == "\n" or text[at + 1 : at + 2].isspace())):
            kind, at = "comment", at + (2 if c == "/" else 1)
        elif c == "\n":
            kind, at = "line", at + 1
        elif text[at : at + 2] in (":=", "=>", "==", "!=", "<=", ">=") or c in "=:+,;(){}[]|":
            kind, at = "op", at + (2 if text[at : at + 2] in (":=", "=>", "==", "!=", "<=", ">=") else 1)
        elif c in "\"'":
            end = None
            if not (before.isascii() and before.isalnum()) or start == 0:
                i = at + 1
                while i < len(text) and text[i] != "\n":
                    if text[i] == "\\":
                        i += 1 if text[i + 1 : i + 2] == "\n" else 2
                    elif text[i] == c:
                        end = i + 1
                        break
                    else:
                        i += 1
            kind, at = ("other", at + 1) if end is None else ("text", end)
        elif c.isspace():
            at += 1
        else:
            kind = "word"
            while at < len(text) and text[at] not in "\"'=:+,;(){}[]|" and not text[at].isspace():
                at += 1
        out.append((kind, text[start:at], start))
    return out


def test_lexing_like_a_plain_lexer():
    rng = random.Random(8)
    letters = ["a", "b1", '"', "'", "\\", "\\\\", '\\"', "#", "//", "/", ":", "=", "!", "<", "+", " ", "\t", "\n", "\r", "é", "|", "(", "$x"]
    for _ in range(20_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        assert secrets.lexed(text) == plain_tokens(text), text


HOSTILE = {
    "doubling": 'x = "ab"\n' + "x = x + x\n" * 100_000,
    "growing": 'token = "ab"\n' + 'token = token + "c1"\n' * 50_000,
    "named growth": "".join(f'a{i} = a{i - 1} + "c{i}"\n' for i in range(50_000)),
    "escaped quotes": "a = " + '\\"' * 500_000,
    "quotes of both kinds": "a = " + "\"'" * 500_000,
    "open quotes": ('"' + "\\" * 9) * 100_000,
    "one long sum": "key = " + '"a" + ' * 170_000,
    "sums of sums": "token = " + "b1 + " * 100_000 + "\n" + "token = token + token\n" * 10_000,
    "one long literal": "token = '" + "a1" * 500_000 + "'\n" + "token = token + token\n" * 1_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_texts_take_linear_time_and_space(name):
    start = time.perf_counter()
    secrets.scan(HOSTILE[name])
    assert time.perf_counter() - start < 30
    tracemalloc.start()  # which makes it ten times slower
    secrets.scan(HOSTILE[name][:100_000])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 100e6


def test_sums_of_constants_end_at_their_bound():
    text = 'x = "0123456789abcdef"\n' + "x = x + x\n" * 30 + 'password = "q8Zr71LmWx" + x'
    found = [p for p in secrets.pairs(text)]
    assert max(len(p.value) for p in found) <= secrets.LONGEST_SUM
    assert found[-1].value == "q8Zr71LmWx"  # the sum would be longer
    long = "ab12" * 1000
    assert [p.value for p in secrets.pairs(f"x = '{long}'\ntoken = x\nkey = x + 'y1'")] == [long, long, long]


def test_pairs_propagate_constants():
    text = 'base = "x9Kqhhh" + "77zzQ1"\ndb_password = base\n{"apiKey": "AB12cd34EF56"}\nexport CLIENT_SECRET=abc123DEF456 # note'
    found = {p.name: p.value for p in secrets.pairs(text)}
    assert found == {"base": "x9Kqhhh77zzQ1", "db_password": "x9Kqhhh77zzQ1", "apiKey": "AB12cd34EF56", "CLIENT_SECRET": "abc123DEF456"}
    marked = [text[s:e] for kind, s, e in secrets.scan(text) if kind == "literal"]
    assert marked == ["x9Kqhhh", "77zzQ1", "AB12cd34EF56", "abc123DEF456"]


@pytest.mark.parametrize("text", [
    "the token: of our love", 'password = "changeme123"', "token_count = 123456789", "a: b", "secret = ${SECRET_VALUE}", "note: it's 5 o'clock = late", "public_key = abc123DEF456xyz",
])
def test_harmless_texts_have_no_literals(text):
    assert secrets.literal_spans(text) == []


@pytest.mark.parametrize("text, literals", [
    ("mirror=https://m.example.org db_pwd=Zx81kQp0aL", ["Zx81kQp0aL"]),
    ("see http://a.org and ftp://b.org then auth_key: 'q8Zr71LmWx'", ["q8Zr71LmWx"]),
    ("# db_pwd = Zx81kQp0aL\nx = 1", ["Zx81kQp0aL"]),
    ("#db_pwd=Zx81kQp0aL", ["Zx81kQp0aL"]),
    ('x = 1 // privateKey: "q8Zr71LmWx"', ["q8Zr71LmWx"]),
    ('# base = "q8Zr71LmWx"\n# db_pwd = base', ["q8Zr71LmWx"]),
    ('base = "q8Zr71LmWx"\n# base = "other"\ndb_pwd = base', ["q8Zr71LmWx"]),
    ("secret://q8Zr71LmWx // a comment", []),
    ("db_pwd = // Zx81kQp0aL", []),
])
def test_urls_and_comments(text, literals):
    assert [text[s:e] for _, s, e in secrets.literal_spans(text)] == literals


def test_removal_of_secrets(spark):
    docs = spark.createDataFrame([(1, 'x token = "abc123DEF456" y', 5), (2, None, 6)], "doc_id long, text string, spans int")
    assert by_id(secrets.remove_secrets(docs), "doc_id", "text", "spans") == [(1, "x [SECRET]\" y", 5), (2, None, 6)]


@pytest.mark.parametrize("find", [secrets.find_secrets, pii.find_personal_data])
def test_edge_rows(edge, empty, find):
    assert len(find(edge).collect()) == len(EDGE_ROWS)
    assert all(r.spans == [] for r in find(edge).collect())
    assert find(empty).collect() == []


def corpus(spark, n=400):
    """Each of three people has an address and a nickname beside it in ever new surroundings."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=40))
        if i < 30:
            text += f" zorblax{'abc'[i % 3]} wrote p{i % 3}@mail.org about " + " ".join(rng.choices(words, k=10))
        rows.append((i, text))
    rows += [(n + i, "only copies have raretermxyz beside q@mail.org here") for i in range(50)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_reveal_an_entity(spark):
    found = {r.term: r.action for r in pii.disclosing_terms(corpus(spark)).collect()}
    assert {"zorblaxa", "zorblaxb", "zorblaxc"} <= set(found)
    assert "raretermxyz" not in found  # one passage, however often copied, is no evidence
    assert len(found) < 8


def test_every_place_of_an_entity_counts():
    """The words beside an earlier place, and each different surroundings of one document."""
    around = [" ".join(f"{'abcdefgh'[i]}{'klmnopqr'[j]}word" for j in range(8)) for i in range(4)]
    text = f"{around[0]} zorblax me@mail.org {around[1]} {around[2]} zorblax me@mail.org {around[3]}"
    rows = pii.text_rows(text + " " + text)
    assert [r["first"] for r in rows] == [1, 0, 0, 0][: len(rows)] and len({r["left"] for r in rows}) > 1
    assert {"aqword", "dkword"} <= {t["term"] for r in rows for t in r["terms"]}
    assert sum(t["fresh"] for r in rows for t in r["terms"] if t["term"] == "zorblax") == 1


def test_rare_entities_reveal_too(spark):
    """Two surroundings suffice, in two documents or in one; an edited copy is not a second one."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    some = lambda n: " ".join(rng.choices(words, k=n))
    rows = [some(30) for _ in range(4000)]
    rows += [f"{some(20)} twodocs x@mail.org {some(20)}" for _ in range(2)]
    rows += [f"{some(20)} onedoc y@mail.org {some(40)} onedoc y@mail.org {some(20)}"]
    before, after = some(20), some(20)
    rows += [f"{before} copied z@mail.org {after}", f"{before} copied z@mail.org changed {after}"]
    rows += [f"{some(20)} alone v@mail.org {some(20)}"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert by_id(pii.disclosing_terms(docs), "term", "action") == [("onedoc", "remove"), ("twodocs", "remove")]


def test_joined_terms_give_the_same(spark, monkeypatch):
    docs = corpus(spark)
    sent, clean = by_id(pii.find_personal_data(docs), "doc_id", "spans"), by_id(pii.sanitise(docs), "doc_id", "text")
    monkeypatch.setattr(pii, "SENT_TERMS", 0)
    assert by_id(pii.find_personal_data(docs), "doc_id", "spans") == sent
    assert by_id(pii.sanitise(docs), "doc_id", "text") == clean
    assert not any("zorblax" in t or "@" in t for _, t in clean)


def test_redaction():
    text = "mail a@b.org, card 4539148803436467 of bob"
    spans = pii.ordered([*pii.base_spans(text), ("remove", text.index("bob"), len(text)), ("generalise", 0, 4)])
    assert pii.redact(text, spans) == "[TERM] [EMAIL], card [CARD] of "


def test_sanitise_keeps_rows_and_columns(edge):
    assert by_id(pii.sanitise(edge), *edge.columns) == by_id(edge, *edge.columns)


@pytest.mark.parametrize("name, plain, module", [("op3_secret_scan", plain_secrets, secrets), ("op5_personal_data", plain_personal, pii)])
def test_query(spark, sf_dir, name, plain, module):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = in_order(plain(texts[r.doc_id]), module.KINDS)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[c] for c in r.__fields__[1:-2]] == [sum(k == kind for k, _, _ in base) for kind in module.KINDS]
        assert set(joined.split(",")) <= set(r.spans.split(","))
