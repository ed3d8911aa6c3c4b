"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: each segment (some megabytes of text) stores, for
every term, the sorted list of its word positions, next to where each document starts.
Phrases are found by intersecting offset-adjusted lists: starting from the rarest term
of a phrase over the whole corpus, its positions minus its offset are the candidates,
and each further term, rarest first, keeps those whose shifted position is in its own
list. All phrases of a block are intersected with a segment at once.

Test sets are the stated queries and go to every segment in blocks of bounded size.
Only the terms of the test set are indexed, so the index takes part of the corpus's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from entidex.llm.common import importable, scratch, text_chunks, tidied, written
from entidex.storage import delete

#: Words of a window. An item of fewer words is one window.
WINDOW = 10
#: Characters of test items that are sent to every task at a time; more go in more blocks, each
#: with an index of its own terms. 2.5 million take 305 MB on the driver and 33 MB in a task.
BLOCK_CHARS = 2_000_000
#: Candidates that are intersected at once; bounds a task's memory.
CANDIDATES = 2_000_000
#: Rows of flagged texts that may be sent to every task; more are joined by shuffle.
SENT_ROWS = 500_000

#: Fixed value: words are runs of a-z (A-Z lower-cased), 0-9 and everything beyond ASCII.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_LETTERS = bytes((b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20) for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def term_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - 2**63


def segment_of(texts: list, known: dict[bytes, int] | None) -> tuple[np.ndarray, ...]:
    """(document starts, terms, term starts, positions) of some texts.

    known: the hash of each term to index; None indexes all. Positions count words over
    all texts of the segment, ascending within a term; terms ascend by hash.
    """
    flat: list[bytes] = []
    starts = [0]
    for text in texts:
        flat += words_of(text)
        starts.append(len(flat))
    if known is None:
        hash_of = {w: term_hash(w) for w in set(flat)}
        ids = np.fromiter(map(hash_of.__getitem__, flat), np.int64, len(flat))
        at = np.arange(len(flat), dtype=np.int32)
    else:
        ids = np.fromiter(map(known.get, flat, repeat(0)), np.int64, len(flat))
        at = np.flatnonzero(ids).astype(np.int32)
        ids = ids[at]
    order = np.argsort(ids, kind="stable")
    ids, at = ids[order], at[order]
    terms, first = np.unique(ids, return_index=True)
    return np.array(starts, np.int32), terms, np.append(first, len(ids)).astype(np.int32), at


def build_index(docs: DataFrame, words: list[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per segment: `segment`, `ids`, `doc_starts`, `terms`, `term_starts`, `positions`.

    words: the terms to index, all if None. Null and empty texts take their place in
    `ids` without words. Write the index before it is used, so that segments keep their names.
    """
    schema = T.StructType(
        [
            T.StructField("segment", T.StringType()),
            T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)),
            *T.StructType.fromDDL("doc_starts array<int>, terms array<bigint>, term_starts array<int>, positions array<int>").fields,
        ]
    )
    arrow = to_arrow_schema(schema)
    known = None if words is None else {w: term_hash(w) for w in words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, texts in text_chunks(batch.column(1)):
                ids = batch.column(0).slice(start, len(texts))
                columns = [pa.array([f"{part}-{n}"]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
                for values in segment_of(texts, known):
                    columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values)))
                n += 1
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow)], schema=arrow)

    return importable(docs).select(id_col, text_col).mapInArrow(tidied(run), schema)


class Phrases:
    """Phrases of equal length and the items they come from."""

    def __init__(self, rows: list[tuple[tuple[bytes, ...], int]], frequency: dict[int, int]):
        """rows: (words, number of the item), each pair once."""
        by_phrase: dict[tuple[bytes, ...], list[int]] = {}
        for phrase, item in rows:
            by_phrase.setdefault(phrase, []).append(item)
        self.length = len(next(iter(by_phrase)))
        terms = np.array([[term_hash(w) for w in phrase] for phrase in by_phrase], np.int64).reshape(-1, self.length)
        rarity = np.array([[frequency.get(t, 0) for t in row] for row in terms.tolist()], np.int64).reshape(-1, self.length)
        self.offsets = np.argsort(rarity, axis=1, kind="stable").astype(np.int32)
        self.terms = np.take_along_axis(terms, self.offsets.astype(np.int64), axis=1)
        occur = rarity.min(axis=1) > 0  # a term that the corpus lacks rules its phrases out
        self.offsets, self.terms = self.offsets[occur], self.terms[occur]
        items = [v for v, o in zip(by_phrase.values(), occur) if o]
        self.item_starts = np.cumsum([0, *map(len, items)])
        self.items = np.array([i for v in items for i in v], np.int64)

    def matches(self, starts: np.ndarray, terms: np.ndarray, term_starts: np.ndarray, positions: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase numbers, first positions) of all occurrences within one document each."""
        if not len(self.terms) or not len(positions):
            return
        width = int(starts[-1]) + 1
        # (number of the term, position) as one ascending key: a list lookup is one search.
        keys = np.repeat(np.arange(len(terms), dtype=np.int64) * width, np.diff(term_starts)) + positions
        number = np.searchsorted(terms, self.terms)
        number[number == len(terms)] = 0
        whole = (terms[number] == self.terms).all(axis=1)
        phrases = np.flatnonzero(whole)
        sizes = np.diff(term_starts)[number[phrases, 0]]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(phrases):
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + CANDIDATES, side="right")))
            chosen, n = phrases[at:stop], sizes[at:stop]
            which = np.repeat(chosen, n)
            within = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            first = positions[term_starts[number[which, 0]] + within].astype(np.int64) - self.offsets[which, 0]
            ok = first >= 0
            which, first = which[ok], first[ok]
            for k in range(1, self.length):
                spot = first + self.offsets[which, k]
                ok = spot < width
                key = number[which, k] * width + spot
                place = np.searchsorted(keys, key)
                place[place == len(keys)] = 0
                ok &= keys[place] == key
                which, first = which[ok], first[ok]
            doc = np.searchsorted(starts, first, side="right")
            ok = first + self.length <= starts[np.minimum(doc, len(starts) - 1)]
            yield which[ok], first[ok]
            at = stop


def item_windows(items: list[tuple[int, list[bytes]]]) -> dict[int, list[tuple[tuple[bytes, ...], int]]]:
    """Distinct windows of numbered items, by length."""
    out: dict[int, set] = {}
    for number, words in items:
        size = min(WINDOW, len(words))
        if size:
            out.setdefault(size, set()).update((tuple(words[i : i + size]), number) for i in range(len(words) - size + 1))
    return {size: sorted(rows) for size, rows in out.items()}


def frequencies(index: DataFrame) -> dict[int, int]:
    """How often each indexed term occurs in the corpus; as many as the test set has terms."""
    sizes = F.transform("terms", lambda t, i: F.struct(t.alias("t"), (F.get("term_starts", i + 1) - F.get("term_starts", i)).alias("n")))
    rows = index.select(F.inline(sizes)).groupBy("t").agg(F.sum("n").alias("n")).collect()
    return {r["t"]: r["n"] for r in rows}


def _matched(index: DataFrame, phrases: list[Phrases], ids: list, item_type: T.DataType) -> DataFrame:
    """Per document of the index: id, n_words, ranges of hit words, items."""
    id_type = index.schema["ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("segment", T.StringType()),
            T.StructField("place", T.IntegerType()),
            T.StructField("id", id_type),
            T.StructField("n_words", T.LongType()),
            T.StructField("hits", T.ArrayType(T.StructType.fromDDL("start int, end int"))),
            T.StructField("items", T.ArrayType(item_type)),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                doc_ids = batch.column(1)[r].values
                starts, terms, term_starts, positions = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in range(2, 6))
                cover = np.zeros(int(starts[-1]) + 1, np.int32)
                found: set[tuple[int, int]] = set()
                for group in phrases:
                    for which, first in group.matches(starts, terms, term_starts, positions):
                        np.add.at(cover, first, 1)
                        np.add.at(cover, first + group.length, -1)
                        docs = np.searchsorted(starts, first, side="right") - 1
                        for doc, phrase in set(zip(docs.tolist(), which.tolist())):
                            found.update((doc, i) for i in group.items[group.item_starts[phrase] : group.item_starts[phrase + 1]].tolist())
                hit = np.cumsum(cover[:-1]) > 0
                # Ranges end where documents do.
                edges = np.zeros(len(hit) + 1, bool)
                edges[starts] = True
                before, after = np.append(False, hit), np.append(hit, False)
                opens = np.flatnonzero(after & (~before | edges))
                closes = np.flatnonzero(before & (~after | edges))
                owner = np.searchsorted(starts, opens, side="right") - 1
                hits: list[list] = [[] for _ in range(len(doc_ids))]
                for doc, s, e in zip(owner.tolist(), opens.tolist(), closes.tolist()):
                    hits[doc].append({"start": s - int(starts[doc]), "end": e - int(starts[doc])})
                items: list[list] = [[] for _ in range(len(doc_ids))]
                for doc, i in sorted(found):
                    if ids[i] is not None:
                        items[doc].append(ids[i])
                columns = [
                    pa.array([batch.column(0)[r].as_py()] * len(doc_ids), pa.string()),
                    pa.array(np.arange(len(doc_ids), dtype=np.int32)),
                    doc_ids,
                    pa.array(np.diff(starts).astype(np.int64)),
                    pa.array(hits, arrow.field("hits").type),
                    pa.array(items, arrow.field("items").type),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow)], schema=arrow)

    return importable(index).mapInArrow(tidied(run), schema)


def n_hit(hits: Column) -> Column:
    """Words in a union of ranges."""
    return F.aggregate(
        F.sort_array(hits),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, h: F.struct((a["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(h["start"], a["to"]))).alias("n"), F.greatest(a["to"], h["end"]).alias("to")),
        lambda a: a["n"].cast("long"),
    )


def phrase_matches(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS, folder: str | None = None
) -> DataFrame:
    """Per document: `id_col`, `n_words`, `n_hit`, `hits` (word ranges), `items` (ids of found items).

    An item is found in a document that holds one of its windows. Null or empty texts
    have no words; an item without id counts for `n_hit` but cannot be listed; repeated
    rows repeat, repeated items count once; empty tables give no rows or no hits; other
    columns are not read.
    """
    folder = folder or scratch(docs.sparkSession)
    item_type = items.schema[item_id].dataType
    total = items.agg(F.sum(F.char_length(item_text))).first()[0] or 0
    blocks = int(total // block_chars) + 1
    keyed = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).filter("t is not null")
    results = []
    for block in range(blocks):
        rows = keyed.filter(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).distinct().collect()
        numbered = [(i, words_of(r["t"])) for i, r in enumerate(rows)]
        vocabulary = sorted({w for _, words in numbered for w in words})
        index = written(build_index(docs, vocabulary, id_col, text_col), folder, f"index-{block}")
        frequency = frequencies(index)
        phrases = [Phrases(found, frequency) for found in item_windows(numbered).values()]
        results.append(_matched(index, phrases, [r["i"] for r in rows], item_type))
    found = results[0]
    if blocks > 1:
        for more in results[1:]:
            found = found.unionByName(more)
        found = found.groupBy("segment", "place").agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
        )
    return found.select(F.col("id").alias(id_col), "n_words", n_hit(F.col("hits")).alias("n_hit"), "hits", F.array_distinct("items").alias("items"))


def proximity_matches(index: DataFrame, queries: list[tuple[int, list[bytes]]], within: int) -> DataFrame:
    """`query`, `id`: documents of an index that hold all words of a query in `within` words.

    queries: a bounded list of (number, words), sent to every task.
    """
    id_type = index.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("id", id_type)])
    arrow = to_arrow_schema(schema)
    hashed = [(number, [term_hash(w) for w in dict.fromkeys(words)]) for number, words in queries if words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column(1)[r].values
                starts, terms, term_starts, positions = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in range(2, 6))
                place = {t: i for i, t in enumerate(terms.tolist())}
                numbers, docs = [], []
                for number, wanted in hashed:
                    if not all(t in place for t in wanted):
                        continue
                    lists = sorted((positions[term_starts[place[t]] : term_starts[place[t] + 1]] for t in wanted), key=len)
                    # The window may start at any of the words.
                    first = np.unique(np.concatenate(lists))
                    end = np.minimum(first + within, starts[np.searchsorted(starts, first, side="right")])
                    for one in lists:
                        at = np.searchsorted(one, first)
                        ok = (at < len(one)) & (one[np.minimum(at, len(one) - 1)] < end)
                        first, end = first[ok], end[ok]
                    found = np.unique(np.searchsorted(starts, first, side="right") - 1)
                    numbers += [number] * len(found)
                    docs.append(found)
                if numbers:
                    chosen = ids.take(pa.array(np.concatenate(docs)))
                    yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), chosen.cast(arrow.field("id").type)], schema=arrow)

    return importable(index).mapInArrow(tidied(run), schema)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    names = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        id_col,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs` whose text holds no window of any item, with their own columns.

    A null or empty text holds none and stays; repeated rows stay or go alike; an item that
    is null or empty has no window; empty tables of items keep all rows.
    """
    keyed = docs.select(F.sha2(text_col, 256).alias("text_key"), F.col(text_col).alias("text_of")).filter("text_of is not null")
    folder = scratch(docs.sparkSession)
    found = phrase_matches(keyed, items, "text_key", "text_of", item_id, item_text, folder=folder)
    flagged = written(found.filter("n_hit > 0").select("text_key").distinct(), scratch(docs.sparkSession), "flagged", few=True)
    delete(docs.sparkSession, folder)
    if flagged.limit(SENT_ROWS + 1).count() <= SENT_ROWS:
        flagged = F.broadcast(flagged)
    return docs.join(flagged, F.sha2(docs[text_col], 256) == flagged["text_key"], "left_anti")
