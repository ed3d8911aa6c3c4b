"""Personal data: patterns, and information-theoretic sanitisation of the words around them.

Patterns find emails, IP addresses, card and phone numbers. Each distinct value is a
protected entity. Corpus co-occurrence then tells how strongly a word reveals it:

    plain(t, e) = PMI(t; e) / IC(e) = 1 - ln(df(t) / df(t near e)) / ln(N / df(e))

with df in documents and "near" within `RADIUS` words of any place that names the entity.
It is 1 where a word never appears but beside the entity, so that reading the word is as
good as reading the entity. Few places are little evidence, so P(e | t) is smoothed: of the
n different surroundings that t and e share, each is foretold by the n - 1 others and by
one that knows P(e) = df(e) / N alone,

    disclosure(t, e) = plain(t, e) - ln(n / (n - 1 + P(e))) / ln(N / df(e))

A single passage, however often copied, thus reveals nothing (its disclosure is 0 at most), while
two surroundings do where the entity is rare. Words whose disclosure is at `GENERALISE` or
above are generalised, those of them whose plain one is at `REMOVE` removed, in all documents.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from entidex.llm.common import SPANS, importable, map_texts, replace_texts, scratch, span_array, span_digest, text_chunks, tidied, written
from entidex.storage import delete
from entidex.operators.extract import quoted

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")

#: The base patterns.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Words a context reaches to either side.
RADIUS = 8
GENERALISE, REMOVE = 0.9, 1.0
#: Most terms that are sent to every task; beyond, terms and documents meet in a join.
SENT_TERMS = 200_000

WORD = re.compile(r"[^\W\d_]{3,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ sign outwards, which costs no more than the text is long; the
    leftmost match of a run of local letters starts where the run does."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        else:
            # A later match may not start before this sign: it is no local letter.
            end = max(end, at)
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 10 else not p.strip("0") or int(p.lstrip("0")[:10] or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


_ORDER = {kind: i for i, kind in enumerate((*KINDS, *TERM_KINDS))}


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def _side_key(side: list[str], near: list[str]) -> int:
    """Hash of one side of an entity; a side cut short by the text's edge is taken with the other."""
    return xxhash.xxh64_intdigest(" ".join(side if len(side) == RADIUS else near)) - 2**63


def contexts(text: str) -> Iterator[tuple[str, str, int, int, set[str]]]:
    """(kind, value, hashes of what is left and right, words near by) for each place of an entity."""
    found = base_spans(text)
    if not found:
        return
    words = [(m.start(), m.end(), m.group().lower()) for m in WORD.finditer(text)]
    covered = sorted((s, e) for _, s, e in found)
    inside = [any(s <= a < e for s, e in covered[max(0, bisect_left(covered, (a, a)) - 1) : bisect_left(covered, (a + 1, a + 1))]) for a, _, _ in words]
    words = [w for w, hide in zip(words, inside) if not hide]
    starts = [w[0] for w in words]
    for kind, start, end in found:
        at, after = bisect_left(starts, start), bisect_left(starts, end)
        left, right = [w[2] for w in words[max(0, at - RADIUS) : at]], [w[2] for w in words[after : after + RADIUS]]
        near = left + right
        value = re.sub(r"[^0-9a-z@.]", "", text[start:end].lower())
        yield kind, value, _side_key(left, near), _side_key(right, near), set(near)


def text_rows(text: str) -> list[dict]:
    """Rows of `entity_rows` for one text; what the text counts for once is marked at its first place."""
    out, met, entities = [], set(), {}
    for kind, value, left, right, near in contexts(text):
        if (kind, value, left, right) in met:
            continue
        met.add((kind, value, left, right))
        first = (kind, value) not in entities
        known = entities.setdefault((kind, value), set())
        terms = [{"term": t, "fresh": int(t not in known)} for t in sorted(near)]
        known |= near
        out.append({"kind": kind, "value": value, "first": int(first), "left": left, "right": right, "terms": terms})
    return out


def entity_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """One row per document, entity and surroundings: kind, value, left, right, terms.

    `first` is 1 in one row of each document and entity, `fresh` in one of each term besides.
    """
    schema = T.StructType.fromDDL("kind string, value string, first long, left long, right long, terms array<struct<term string, fresh long>>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_chunks(batch.column(0)):
                rows = [row for text in texts if text for row in text_rows(text)]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return importable(docs).select(text_col).mapInArrow(tidied(run), schema)


def term_counts(docs: DataFrame, text_col: str, terms: frozenset | None) -> DataFrame:
    """`term`, `df`: documents each term occurs in; of the given terms, or of all words."""
    schema = T.StructType.fromDDL("term string, n long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_chunks(batch.column(0)):
                count: Counter = Counter()
                for text in texts:
                    words = set(WORD.findall((text or "").lower()))
                    count.update(words if terms is None else words & terms)
                yield pa.RecordBatch.from_pydict({"term": list(count), "n": list(count.values())}, schema=arrow)

    return importable(docs).select(text_col).mapInArrow(tidied(run), schema).groupBy("term").agg(F.sum("n").alias("df"))


def disclosing_terms(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`term`, `action` (generalise or remove) and `disclosure`: words that reveal an entity.

    All documents count. Where no entity recurs in different surroundings there are none;
    surroundings differ where both sides do, so that an edit to one side of a copy makes none.
    """
    folder, result = scratch(docs.sparkSession), scratch(docs.sparkSession)
    rows = written(entity_rows(docs, text_col), folder, "contexts")
    entities = rows.groupBy("kind", "value").agg(F.sum("first").alias("df_e"))
    near = (
        rows.select("kind", "value", "left", "right", F.inline("terms"))
        .groupBy("kind", "value", "term")
        .agg(F.sum("fresh").alias("df_near"), F.count_distinct("left").alias("lefts"), F.count_distinct("right").alias("rights"))
        .select("kind", "value", "term", "df_near", F.least("lefts", "rights").alias("contexts"))
        # Loses nothing: with one surrounding the disclosure is 0 at most.
        .filter("contexts > 1")
    )
    near = written(near.join(entities, ["kind", "value"]), folder, "near", few=True)
    total = docs.count()
    terms = near.select("term").distinct()
    sent = terms.limit(SENT_TERMS + 1).collect()
    if len(sent) <= SENT_TERMS:
        df = term_counts(docs, text_col, frozenset(r["term"] for r in sent))
    else:
        df = term_counts(docs, text_col, None)
    information = F.log(F.lit(float(max(total, 1))) / F.col("df_e"))
    plain = 1 - F.log(F.greatest(F.col("df"), F.col("df_near")) / F.col("df_near")) / information
    smoothed = plain - F.log(F.col("contexts") / (F.col("contexts") - 1 + F.col("df_e") / F.lit(float(max(total, 1))))) / information
    revealing = (
        near.join(df, "term")
        .filter(information > 0)
        .select("term", plain.alias("plain"), smoothed.alias("disclosure"))
        .filter(F.col("disclosure") >= GENERALISE)
        .groupBy("term")
        .agg(F.max("plain").alias("plain"), F.max("disclosure").alias("disclosure"))
        .select("term", F.when(F.col("plain") >= REMOVE, "remove").otherwise("generalise").alias("action"), "disclosure")
    )
    found = written(revealing, result, "revealing", few=True)
    delete(docs.sparkSession, folder)
    return found


def with_term_spans(text: str, terms: dict[str, str]) -> list[tuple[str, int, int]]:
    """Base spans and the spans of revealing terms, in order."""
    out = base_spans(text)
    if terms and not terms.keys().isdisjoint(WORD.findall(text.lower())):
        out += [(terms[w], *m.span()) for m in WORD.finditer(text) if (w := m.group().lower()) in terms]
    return ordered(out)


def _sent(terms: DataFrame) -> dict[str, str] | None:
    """The terms as a dictionary, or None if they are too many to send."""
    rows = terms.select("term", "action").limit(SENT_TERMS + 1).collect()
    return {r["term"]: r["action"] for r in rows} if len(rows) <= SENT_TERMS else None


def _own_terms(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """`key` (hash of a text) and `own`, the revealing terms it holds as `action:term`."""
    schema = "key string, term string"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for start, texts in text_chunks(batch.column(1)):
                rows = [{"key": k, "term": w} for k, t in zip(keys[start:], texts) for w in set(WORD.findall(t.lower()))]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    keyed = importable(docs).filter(F.col(text_col).isNotNull()).select(F.sha2(text_col, 256).alias("key"), text_col).dropDuplicates(["key"])
    held = keyed.mapInArrow(tidied(run), schema).join(terms.select("term", "action"), "term")
    return held.groupBy("key").agg(F.collect_list(F.concat_ws(":", "action", "term")).alias("own"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: DataFrame | None = None) -> DataFrame:
    """`id_col` and `spans` (kind, start, end in code points, end exclusive) of every row.

    Kinds: email, ip, card, phone (base), generalise and remove (revealing terms; found
    over `docs` unless given). A null or empty text has no spans; repeated rows repeat;
    an empty table gives none; other columns are not read.
    """
    terms = disclosing_terms(docs, text_col) if terms is None else terms
    sent = _sent(terms)
    if sent is not None:
        make = lambda: lambda texts: [span_array([with_term_spans(t or "", sent) for t in texts])]
        return map_texts(docs, id_col, text_col, make, f"spans {SPANS}")
    own = _own_terms(docs, text_col, terms)
    one = docs.select(id_col, F.col(text_col).alias("text"), F.sha2(text_col, 256).alias("key")).join(own, "key", "left")
    both = one.select(F.col(id_col), F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("own", F.array().cast("array<string>")).alias("own"))).alias("both"))

    def apply(rows: list) -> list[pa.Array]:
        import json

        out = []
        for row in map(json.loads, rows):
            actions = dict(reversed(x.split(":", 1)) for x in row["own"])
            out.append(with_term_spans(row["text"], actions))
        return [span_array(out)]

    return map_texts(both, id_col, "both", lambda: apply, f"spans {SPANS}")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Entities give way to `[KIND]`, generalised terms to `[TERM]`, removed terms to nothing.

    Of overlapping spans the first to start, then the first kind, names the replacement.
    """
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], "" if kind == "remove" else "[TERM]" if kind == "generalise" else f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with personal data and revealing terms out of `text_col`.

    Null texts stay null; every row and every other column is kept as it is.
    """
    sent = _sent(terms := disclosing_terms(docs, text_col))
    if sent is not None:
        clean = lambda t: t if t is None else redact(t, with_term_spans(t, sent))
        return replace_texts(docs, text_col, lambda: lambda texts: [clean(t) for t in texts])
    # Too many terms for every task: each text brings its own, packed in front of it.
    own = _own_terms(docs, text_col, terms).select(F.col("key").alias("__key"), F.to_json(F.struct("own")).alias("__own"))
    packed = docs.withColumn("__key", F.sha2(text_col, 256)).join(own, "__key", "left")
    packed = packed.withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.concat(F.coalesce("__own", F.lit('{"own":[]}')), F.lit("\n"), F.col(text_col)))).select(*map(quoted, docs.columns))

    def apply(texts: list) -> list:
        import json

        out = []
        for packed_text in texts:
            if packed_text is None:
                out.append(None)
                continue
            head, text = packed_text.split("\n", 1)
            actions = dict(reversed(x.split(":", 1)) for x in json.loads(head)["own"])
            out.append(redact(text, with_term_spans(text, actions)))
        return out

    return replace_texts(packed, text_col, lambda: apply)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, *span_digest("spans", KINDS, tuple(f"n_{k}" for k in KINDS)))
