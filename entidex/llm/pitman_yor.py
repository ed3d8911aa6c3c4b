"""Language-model scores by a hierarchical Pitman-Yor model.

The vocabulary's restaurant, with a uniform base, is the parent of one restaurant per
context; the context of a token is its previous token, by hash. There are as many classes of
that hash as the texts have words by a rough count (`contexts_for`), so that most previous
words have a restaurant of their own, however large the corpus is, up to `MOST_CONTEXTS`. A
restaurant seats its customers (tokens) at tables by the Chinese-restaurant process;
every table of a context is a customer of the parent. Gibbs sweeps reseat the customers
of each dish given all others; the predictive probabilities of the sweeps after `BURN_IN`
are averaged and give each text's log probability.

Reseating dish w with n customers needs only how many tables are open: customer i opens
one with probability a / (i - 1 - d t + a), where t are the dish's tables and
a = (theta + d T) P_parent(w). T, the tables of the whole restaurant, and P_parent are those
of the sweep before. All dishes are thus independent within a sweep, words are dealt to
shards by hash, and only the totals of the contexts are exchanged, as one array. Draws are
hashes of the dish, the sweep and the customer's number, so the seating does not depend on
the shards, and a task replays the earlier sweeps from their totals instead of storing any
seating; a lost executor costs nothing but that.

Tokens travel once: per chunk of texts and shard as one block of counts and postings
(which document a token is of). Words that take a large share of a chunk keep their
postings at the chunk and only send counts, so that no shard grows with one hot word.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from entidex.llm.common import importable, scratch, text_chunks, tidied, written
from entidex.llm.jaccard import Shingler, mixed

#: Sweeps: all, and those whose probabilities are not averaged.
SWEEPS, BURN_IN = 4, 1
#: Code points of text per context restaurant; fewest and most of these. The most make an
#: array of 8 MB, which the driver and every task hold once per sweep.
CHARS_PER_CONTEXT, LEAST_CONTEXTS, MOST_CONTEXTS = 64, 1 << 8, 1 << 20
#: Totals that are added up together, and code points of text per shard; most shards.
SLICE, CHARS_PER_SHARD, MOST_SHARDS = 1 << 14, 4_000_000, 4096
#: Concentration of every restaurant. Discounts come from counts of counts.
CONCENTRATION = 1.0
#: Customers of a dish that are seated one by one; beyond, by blocks of an eighth of
#: those seated, within which the chance to open a table is held.
ONE_BY_ONE = 64
#: Draws that are made at once.
DRAWS = 1_000_000
#: Bytes of a chunk of texts, and the most texts in one.
CHUNK_TEXT, CHUNK_ROWS = 4_000_000, 32_000
#: Smoothing of the base score; documents whose id hashes to 0 of `FOLDS` are held out.
SMOOTHING, FOLDS = 0.1, 10
SEED = 7

#: Names of the end of a text (a token) and of its start (a context).
END, START = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557)


def held_out(doc_id) -> bool:
    """Whether a document is no part of the training text; a null id hashes as empty."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == 0


def packed(values: np.ndarray, kind) -> bytes:
    """Numbers as bytes: their first bytes, then their second ones and so on, compressed."""
    raw = np.ascontiguousarray(values, dtype=kind)
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(-1, raw.itemsize).T)
    return planes.size.to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, kind) -> np.ndarray:
    kind, size = np.dtype(kind), int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def run_starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


_KIND = np.uint32  # of a context's class
_SHARD = "words binary, per_word binary, contexts binary, counts binary, keys binary, repeats binary, posts binary"


def contexts_for(n_chars: int) -> int:
    """Classes of previous words for so much text: a power of two."""
    return min(MOST_CONTEXTS, max(LEAST_CONTEXTS, 1 << (n_chars // CHARS_PER_CONTEXT).bit_length()))


def blocks(docs: DataFrame, id_col: str, text_col: str, shards: int, classes: int = LEAST_CONTEXTS) -> DataFrame:
    """Rows of three kinds, each with the shard it is dealt to.

    docs: `part`, `ids`, `lengths`, `posts` (held-out flags) of a chunk. shard: the distinct
    (word, context) keys a chunk has in a shard, their training counts, and the postings of
    each key. hot: the same postings for one word that is frequent in the chunk, and in
    `home` the shard that has its counts.
    """
    schema = T.StructType(
        [
            *T.StructType.fromDDL("kind string, shard int, part bigint").fields,
            T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)),
            *T.StructType.fromDDL(f"lengths binary, {_SHARD}, home int").fields,
        ]
    )
    arrow = to_arrow_schema(schema)
    names = [f.name for f in arrow]

    def row(**values) -> dict:
        return {name: values.get(name) for name in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        start_class = mixed(np.array([START])) % np.uint64(classes)
        for batch in batches:
            cut = (batch.slice(a, CHUNK_ROWS) for a in range(0, batch.num_rows, CHUNK_ROWS))
            for rows_of, start, texts in ((c, s, t) for c in cut for s, t in text_chunks(c.column(1), CHUNK_TEXT)):
                part = (task << 24) | n
                n += 1
                ids = rows_of.column(0).slice(start, len(texts)).to_pylist()
                held = np.array([held_out(i) for i in ids], bool)
                hashes, place, lengths = Shingler.places(texts)
                lengths = lengths + 1  # with the end
                firsts = np.cumsum(lengths) - lengths
                # A token is its word's number here, by hash, until its key is known.
                words, number_of = np.unique(np.append(hashes, END), return_inverse=True)
                token = np.full(int(lengths.sum()), number_of[-1], np.uint64)
                is_word = np.ones(len(token), bool)
                is_word[firsts + lengths - 1] = False
                token[is_word] = number_of[place]
                context = np.empty_like(token)
                context[1:] = (mixed(words) % np.uint64(classes))[token[:-1]]
                context[firsts] = start_class
                # Word, context and document as one number: at most 21, 20 and 15 bits in a
                # chunk of many texts; a longer text stands alone and takes none for documents.
                doc_bits, context_bits = (np.uint64((most - 1).bit_length()) for most in (len(texts), classes))
                token = ((token << context_bits | context) << doc_bits) | np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)
                token.sort()
                doc = (token & ((np.uint64(1) << doc_bits) - np.uint64(1))).astype(np.uint16)
                token >>= doc_bits
                key_starts = run_starts(token)
                keys = token[key_starts]
                contexts = (keys & ((np.uint64(1) << context_bits) - np.uint64(1))).astype(_KIND)
                word = keys >> context_bits
                first_key = run_starts(word)
                per_word = np.diff(np.append(first_key, len(word)))
                repeats = np.diff(np.append(key_starts, len(token)))
                training = np.add.reduceat((~held)[doc].astype(np.int64), key_starts)
                yield pa.RecordBatch.from_pylist(
                    [row(kind="docs", shard=part % shards, part=part, ids=ids, lengths=packed(lengths, np.int64), posts=packed(held, np.uint8))], schema=arrow
                )
                # Words of a large share stay, but for their counts.
                word_starts = key_starts[first_key]
                sizes = np.diff(np.append(word_starts, len(token)))
                shard = ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
                is_hot = (sizes * 4 * shards > len(token)) & (len(token) > 1000 * shards)
                rows = []
                for h in np.flatnonzero(is_hot).tolist():
                    a, ka = int(word_starts[h]), int(first_key[h])
                    b, kb = a + int(sizes[h]), ka + int(per_word[h])
                    rows.append(
                        row(kind="hot", shard=(part + h) % shards, home=int(shard[h]), part=part, words=words[h : h + 1].tobytes(), contexts=packed(contexts[ka:kb], contexts.dtype), repeats=packed(repeats[ka:kb], np.uint32), posts=packed(doc[a:b], np.uint16))
                    )
                if rows:
                    doc = doc[~np.repeat(is_hot, sizes)]
                # Shards are ranges of the hash, in which the keys are sorted.
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                key_cuts = np.append(first_key, len(word))[cuts]
                sent = np.where(np.repeat(is_hot, per_word), 0, repeats)
                post_cuts = np.append(0, np.cumsum(sent))[key_cuts]
                places = (x.tolist() for x in (cuts, key_cuts, post_cuts))
                for s, ((u, v), (a, b), (i, j)) in enumerate(zip(*(zip(x[:-1], x[1:]) for x in places))):
                    if a == b:
                        continue
                    rows.append(
                        row(
                            kind="shard", shard=s, part=part, words=packed(words[u:v], np.uint64), per_word=packed(per_word[u:v], np.uint32),
                            contexts=packed(contexts[a:b], contexts.dtype), counts=packed(training[a:b], np.uint32), repeats=packed(sent[a:b], np.uint32),
                            posts=packed(doc[i:j], np.uint16),
                        )
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return importable(docs).select(id_col, text_col).mapInArrow(tidied(run), schema)


def ordered(number: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by word number, then context, and where a key differs from the one before."""
    bits = [int(x.max()).bit_length() for x in (number, contexts)]
    place_bits = (len(number) - 1).bit_length()
    if sum(bits) + place_bits > 64:
        order = np.lexsort((contexts, number))
        n, k = number[order], contexts[order]
        return order, np.append(True, (n[1:] != n[:-1]) | (k[1:] != k[:-1]))
    # Word, context and place as one number sort several times faster.
    key = (number.astype(np.uint64) << np.uint64(bits[1]) | contexts) << np.uint64(place_bits) | np.arange(len(number), dtype=np.uint64)
    key.sort()
    order = (key & np.uint64((1 << place_bits) - 1)).astype(np.int64)
    key >>= np.uint64(place_bits)
    return order, np.append(True, key[1:] != key[:-1])


def merged(dealt: DataFrame) -> DataFrame:
    """One row per shard with its keys over all chunks; other kinds as they are.

    words, per_word, contexts, counts: the shard's keys by (word, context) and their
    training counts. keys, repeats, posts, and `parts` (part, its number of keys and posts):
    postings of each chunk. Also training words and tokens, and keys met once and twice.
    """
    fields = [*dealt.schema.fields, *T.StructType.fromDDL("parts binary, n_words bigint, n_tokens bigint, ones bigint, twos bigint").fields]
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == "shard":
                    held.setdefault(r["shard"], []).append(r)
                else:
                    yield pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in arrow}], schema=arrow)
        for shard in sorted(held):
            rows = sorted(held.pop(shard), key=lambda r: r["part"])
            per_word = np.concatenate([unpacked(r["per_word"], np.uint32) for r in rows])
            counts = np.concatenate([unpacked(r["counts"], np.uint32) for r in rows]).astype(np.int64)
            contexts = [unpacked(r["contexts"], _KIND) for r in rows]
            sizes = [len(k) for k in contexts]
            repeats, posts = np.concatenate([unpacked(r["repeats"], np.uint32) for r in rows]), [unpacked(r["posts"], np.uint16) for r in rows]
            w, number_of = np.unique(np.concatenate([unpacked(r["words"], np.uint64) for r in rows]), return_inverse=True)
            order, first = ordered(np.repeat(number_of, per_word), np.concatenate(contexts))
            number = np.empty(len(order), np.uint32)
            number[order] = np.cumsum(first) - 1
            starts = np.flatnonzero(first)
            count = np.add.reduceat(counts[order], starts)
            own = order[starts]
            w, k = w[np.repeat(number_of, per_word)[own]], np.concatenate(contexts)[own]
            word_starts = run_starts(w)
            word_count = np.add.reduceat(count, word_starts)
            parts = np.array([(r["part"], size, len(own)) for r, size, own in zip(rows, sizes, posts)], np.int64)
            yield pa.RecordBatch.from_pylist(
                [
                    {f.name: None for f in arrow}
                    | dict(
                        kind="shard", shard=shard, words=packed(w[word_starts], np.uint64), per_word=packed(np.diff(np.append(word_starts, len(w))), np.uint32), contexts=packed(k, _KIND),
                        counts=packed(count, np.int64), keys=packed(number, np.uint32), repeats=packed(repeats, np.uint32), posts=packed(np.concatenate(posts), np.uint16), parts=packed(parts, np.int64),
                        n_words=int((word_count > 0).sum()), n_tokens=int(count.sum()),
                        ones=int((count == 1).sum()), twos=int((count == 2).sum()),
                    )
                ],
                schema=arrow,
            )

    return dealt.mapInArrow(tidied(run), schema)


def uniform(seeds: np.ndarray, numbers) -> np.ndarray:
    """The draw of each seed with a number, in [0, 1)."""
    return (mixed(seeds + np.asarray(numbers, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) * 2.0**-53


def successes(seeds: np.ndarray, first: int, draws: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """How many of each seed's next draws fall below its chance."""
    out, ends, start = np.zeros(len(draws), np.int64), np.cumsum(draws), 0
    while start < len(draws):
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + DRAWS, side="right")))
        # A dish of very many draws takes several turns.
        for low in range(0, int(draws[start]) if stop == start + 1 else 1, DRAWS):
            n = np.minimum(draws[start:stop] - low, DRAWS) if stop == start + 1 else draws[start:stop]
            starts = np.cumsum(n) - n
            number = np.arange(int(n.sum())) - np.repeat(starts, n) + (first + low)
            below = uniform(np.repeat(seeds[start:stop], n), number) < np.repeat(chance[start:stop], n)
            out[start:stop] += np.add.reduceat(below, starts, dtype=np.int64)
        start = stop
    return out


def seat(customers: np.ndarray, a: np.ndarray, discount: float, seeds: np.ndarray) -> np.ndarray:
    """Tables after seating the customers of each dish; a: (theta + d T) P_parent(dish)."""
    tables = np.minimum(customers, 1)
    order = largest_first(customers)
    tables[order] = seat_several(customers[order], a[order], discount, seeds[order])
    return tables


def largest_first(customers: np.ndarray) -> np.ndarray:
    """Dishes of more than one customer, those with most first."""
    several = np.flatnonzero(customers > 1)
    return several[np.argsort(-customers[several], kind="stable")]


def seat_several(n: np.ndarray, weight: np.ndarray, discount: float, seeds: np.ndarray) -> np.ndarray:
    """The same as `seat` for dishes of n customers, those with most first, none with one alone."""
    t, fewer, seated, block, active = np.ones(len(n)), -n, 1, 1, len(n)
    while active:
        # Those with more customers come first: the active ones are a prefix.
        chance = weight[:active] / (seated - discount * t[:active] + weight[:active])
        if block == 1:
            t[:active] += uniform(seeds[:active], seated) < chance
        else:
            t[:active] += successes(seeds[:active], seated, np.minimum(block, n[:active] - seated), chance)
        seated += block
        block = 1 if seated < ONE_BY_ONE else max(1, seated // 8)
        active = int(np.searchsorted(fewer[:active], -seated, side="left"))
    return t.astype(np.int64)


class Shard:
    """The restaurants' dishes of one shard, replayed from the totals of each sweep.

    model: scalars, the number of contexts and their tokens. Totals: tables of every
    context, then customers and tables of the parent. wanted: the words whose
    dishes alone are served; each dish is seated by itself, so these are seated as among all.
    """

    def __init__(self, words: bytes, per_word: bytes, contexts: bytes, counts: bytes, model: dict, wanted: np.ndarray | None = None):
        self.model = model
        self.words = unpacked(words, np.uint64)
        per_word = unpacked(per_word, np.uint32).astype(np.int64)
        self.contexts = unpacked(contexts, _KIND).astype(np.int64)
        self.counts = unpacked(counts, np.int64)
        if wanted is not None:
            of_word = np.isin(self.words, wanted)
            own = np.repeat(of_word, per_word)
            self.words, per_word, self.contexts, self.counts = self.words[of_word], per_word[of_word], self.contexts[own], self.counts[own]
        self.word_of = np.repeat(np.arange(len(self.words)), per_word)
        self.starts = np.cumsum(per_word) - per_word
        self.tables = np.minimum(self.counts, 1)
        # Keys that a sweep reseats: a single customer has its table.
        self.several = largest_first(self.counts)
        self.seeds = mixed(self.words)[self.word_of[self.several]] + mixed(self.contexts[self.several].astype(np.uint64) + np.uint64(SEED))
        self.word_count = np.add.reduceat(self.counts, self.starts) if len(self.starts) else np.empty(0, np.int64)
        self.customers = np.add.reduceat(self.tables, self.starts) if len(self.starts) else self.word_count
        self.parent_tables = np.minimum(self.customers, 1)

    def add_totals(self, to: np.ndarray) -> None:
        np.add.at(to, self.contexts, self.tables)
        to[-2:] += self.customers.sum(), self.parent_tables.sum()

    def parent(self, totals: np.ndarray) -> np.ndarray:
        """P_parent of each word, given the totals of its present seating."""
        m = self.model
        return (self.customers - m["d0"] * self.parent_tables + (CONCENTRATION + m["d0"] * totals[-1]) / (m["V"] + 1)) / (CONCENTRATION + totals[-2])

    def back_off(self, totals: np.ndarray, keys=slice(None)) -> np.ndarray:
        return (CONCENTRATION + self.model["d1"] * totals[self.contexts[keys]]) * self.parent(totals)[self.word_of[keys]]

    def sweep(self, number: int, totals: np.ndarray) -> None:
        """Reseats all customers; totals: of the seating before."""
        m, turn = self.model, mixed(np.array([number], np.uint64))[0]
        self.tables[self.several] = seat_several(self.counts[self.several], self.back_off(totals, self.several), m["d1"], mixed(self.seeds ^ turn))
        self.customers = np.add.reduceat(self.tables, self.starts) if len(self.starts) else self.customers
        base = np.full(len(self.words), (CONCENTRATION + m["d0"] * totals[-1]) / (m["V"] + 1))
        self.parent_tables = seat(self.customers, base, m["d0"], mixed(self.words ^ turn))

    def probabilities(self, totals: np.ndarray) -> np.ndarray:
        """P(word | context) of each key, given the totals of the present seating."""
        return (self.counts - self.model["d1"] * self.tables + self.back_off(totals)) / (CONCENTRATION + self.model["C"][self.contexts])

    def averaged(self, history: list[np.ndarray]) -> np.ndarray:
        """Mean predictive probability of each key over the sweeps after burn-in."""
        total = np.zeros(len(self.counts))
        for number in range(1, len(history)):
            self.sweep(number, history[number - 1])
            if number > BURN_IN:
                total += self.probabilities(history[number])
        return total / max(1, len(history) - 1 - BURN_IN)


_MODEL_COLUMNS = ("words", "per_word", "contexts", "counts")


_ADDED = "kind int, slice int, totals binary"


def added(parts: DataFrame) -> dict[int, dict[int, np.ndarray]]:
    """Arrays of totals by kind and slice, added up over all tasks."""
    arrow = to_arrow_schema(T.StructType.fromDDL(_ADDED))

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(t, np.int64) for t in rows.column("totals").to_pylist())
        return pa.Table.from_pylist([{"kind": rows.column("kind")[0].as_py(), "slice": rows.column("slice")[0].as_py(), "totals": total.tobytes()}], schema=arrow)

    found: dict[int, dict[int, np.ndarray]] = {}
    for r in parts.groupBy("kind", "slice").applyInArrow(add, _ADDED).collect():
        found.setdefault(r["kind"], {})[r["slice"]] = np.frombuffer(r["totals"], np.int64)
    return found


def whole(slices: dict[int, np.ndarray], size: int) -> np.ndarray:
    """One array of its slices; those that are not there are zero."""
    out = np.zeros(size, np.int64)
    for number, values in slices.items():
        out[number * SLICE : number * SLICE + len(values)] = values
    return out


def fitted(stored: DataFrame, classes: int) -> tuple[dict, list[np.ndarray]]:
    """The model, and the totals of the first seating and of every sweep.

    Three arrays of a number per context reach the driver at a time, added up by Spark.
    """
    shards = stored.filter("kind = 'shard'")
    one = shards.agg(*(F.sum(c).alias(c) for c in ("n_words", "n_tokens", "ones", "twos"))).first()
    discount = lambda ones, twos: min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
    model = {"V": one["n_words"] or 0, "N": one["n_tokens"] or 0, "d1": discount(one["ones"] or 0, one["twos"] or 0), "d0": 0.5}
    history: list[np.ndarray] = []
    arrow = to_arrow_schema(T.StructType.fromDDL(_ADDED))
    context = stored.sparkSession.sparkContext
    for number in range(SWEEPS + 1):
        known = context.broadcast((model, history))  # a few arrays of at most `MOST_CONTEXTS` numbers

        def run(batches: Iterator[pa.RecordBatch], number=number, known=known) -> Iterator[pa.RecordBatch]:
            model, history = known.value
            total, tokens, met = np.zeros(classes + 2, np.int64), np.zeros(classes if number == 0 else 0, np.int64), np.zeros(2, np.int64)
            for batch in batches:
                for r in batch.to_pylist():
                    shard = Shard(*(r[c] for c in _MODEL_COLUMNS), model)
                    for s in range(1, number + 1):
                        shard.sweep(s, history[s - 1])
                    shard.add_totals(total)
                    if number == 0:
                        np.add.at(tokens, shard.contexts, shard.counts)
                    met += int((shard.customers == 1).sum()), int((shard.customers == 2).sum())
            for kind, values in enumerate((total, tokens, met)):
                for start in range(0, len(values), SLICE):
                    part = values[start : start + SLICE]
                    if part.any():
                        yield pa.RecordBatch.from_pylist([{"kind": kind, "slice": start // SLICE, "totals": part.tobytes()}], schema=arrow)

        # One array per core.
        model_rows = importable(shards).select(*_MODEL_COLUMNS).coalesce(context.defaultParallelism)
        sums = added(model_rows.mapInArrow(tidied(run), _ADDED))
        if number == 0:
            model["C"] = whole(sums.get(1, {}), classes)
            ones, twos = whole(sums.get(2, {}), 2).tolist()
            model["d0"] = discount(ones, twos)
        history.append(whole(sums.get(0, {}), classes + 2))
        known.unpersist()
    return model, history


_SUMS = "part bigint, posts binary, score binary, base binary, known binary"


def summed_by_doc(doc: np.ndarray, score: np.ndarray, base: np.ndarray, known: np.ndarray) -> dict:
    """Sums per document of one chunk, for the documents met."""
    size = int(doc.max()) + 1 if len(doc) else 0
    met = np.flatnonzero(np.bincount(doc, minlength=size))
    add = lambda v: np.bincount(doc, weights=v, minlength=size)[met]
    return {"posts": packed(met, np.uint16), "score": packed(add(score), np.float64), "base": packed(add(base), np.float64), "known": packed(add(known), np.uint32)}


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: `id_col`, held_out, n_tokens, n_known, train_tokens, base_score, score.

    docs: a stored table, which tasks can read again alike. Scores do not depend on how the
    table or the shuffle is partitioned (but for the last digits of sums). Tokens are the words, A-Z in
    lower case, and one end. base_score: smoothed unigram log10 probability; score: that of
    the model. A null or empty text is its end alone; a null id is held out; repeated rows
    repeat, and count as often; an empty table gives none; other columns are not read.
    """
    spark, folder = docs.sparkSession, scratch(docs.sparkSession)
    n_chars = docs.agg(F.sum(F.char_length(F.col(text_col))).alias("n")).first()["n"] or 0
    classes = contexts_for(n_chars)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_SHARDS, n_chars // CHARS_PER_SHARD))
    dealt = blocks(docs, id_col, text_col, shards, classes).repartitionById(shards, F.col("shard"))
    stored = written(merged(dealt), folder, "shards")
    model, history = fitted(stored, classes)
    known = spark.sparkContext.broadcast((model, history))
    n_tokens = model["N"]
    floor = math.log10(model["N"] + SMOOTHING * (model["V"] + 1)) if model["N"] else math.log10(SMOOTHING)
    sums = to_arrow_schema(T.StructType.fromDDL(_SUMS))
    hot_schema = "word binary, contexts binary, score binary, base double, known int"
    hot_arrow = to_arrow_schema(T.StructType.fromDDL(hot_schema))

    def logs(r: dict, wanted: np.ndarray | None = None) -> tuple[Shard, np.ndarray, np.ndarray]:
        model, history = known.value
        shard = Shard(*(r[c] for c in _MODEL_COLUMNS), model, wanted)
        return shard, np.log10(shard.averaged(history)), np.log10(shard.word_count + SMOOTHING) - floor

    def score_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                shard, score, base = logs(r)
                base, met = base[shard.word_of], (shard.word_count > 0)[shard.word_of]
                keys, repeats, posts = unpacked(r["keys"], np.uint32), unpacked(r["repeats"], np.uint32), unpacked(r["posts"], np.uint16)
                key_at = post_at = 0
                for part, n_keys, n_posts in unpacked(r["parts"], np.int64).reshape(-1, 3).tolist():
                    key, times = keys[key_at : key_at + n_keys], repeats[key_at : key_at + n_keys]
                    doc = posts[post_at : post_at + n_posts].astype(np.int64)
                    key_at, post_at = key_at + n_keys, post_at + n_posts
                    yield pa.RecordBatch.from_pylist([{"part": part} | summed_by_doc(doc, *(np.repeat(v[key], times) for v in (score, base, met)))], schema=sums)

    def score_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                wanted = np.unique(np.frombuffer(b"".join(r["hot"]), np.uint64))
                shard, score, base = logs(r, wanted)
                for place in range(len(shard.words)):
                    own = slice(*np.searchsorted(shard.word_of, [place, place + 1]))
                    row = {"word": shard.words[place : place + 1].tobytes(), "contexts": packed(shard.contexts[own], _KIND), "score": packed(score[own], np.float64), "base": float(base[place]), "known": int(shard.word_count[place] > 0)}
                    yield pa.RecordBatch.from_pylist([row], schema=hot_arrow)

    def sum_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                place = np.searchsorted(unpacked(r["all_contexts"], _KIND), unpacked(r["contexts"], _KIND))
                score = np.repeat(unpacked(r["score"], np.float64)[place], unpacked(r["repeats"], np.uint32))
                doc = unpacked(r["posts"], np.uint16).astype(np.int64)
                row = {"part": r["part"]} | summed_by_doc(doc, score, np.full(len(doc), r["base"]), np.full(len(doc), r["known"]))
                yield pa.RecordBatch.from_pylist([row], schema=sums)

    shard_rows = importable(stored).filter("kind = 'shard'")
    from_shards = shard_rows.select(*_MODEL_COLUMNS, "keys", "repeats", "posts", "parts").mapInArrow(tidied(score_shards), _SUMS)
    # Hot words: their probabilities meet the postings that stayed at the chunks.
    hot = stored.filter("kind = 'hot'").select(F.col("words").alias("word"), "home", "part", "contexts", "repeats", "posts")
    asked = hot.groupBy(F.col("home").alias("shard")).agg(F.collect_set("word").alias("hot"))
    asked = written(asked, folder, "hot-words", few=True)
    if not asked.isEmpty():
        found = shard_rows.select("shard", *_MODEL_COLUMNS).join(asked, "shard").mapInArrow(tidied(score_hot), hot_schema)
        found = written(found.withColumnRenamed("contexts", "all_contexts"), folder, "hot-scores", few=True)
        both = hot.join(found, "word").select("part", "contexts", "repeats", "posts", "all_contexts", "score", "base", "known")
        from_shards = from_shards.unionByName(both.mapInArrow(tidied(sum_hot), _SUMS))

    id_type = docs.schema[id_col].dataType
    chunks_of = stored.filter("kind = 'docs'").select("part", "ids", "lengths", "posts")
    rows = from_shards.withColumn("ids", F.lit(None).cast(T.ArrayType(id_type))).withColumn("lengths", F.lit(None).cast("binary"))
    rows = rows.unionByName(chunks_of, allowMissingColumns=True).select("part", "ids", "lengths", "posts", "score", "base", "known")
    result = T.StructType([T.StructField(id_col, id_type), *T.StructType.fromDDL("held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").fields])
    out = to_arrow_schema(result)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by part, the chunk's documents first.
        part = ids = None

        def finished() -> pa.RecordBatch:
            n = len(ids)
            columns = [ids, pa.array(held), pa.array(lengths), pa.array(known.astype(np.int64)), pa.array(np.full(n, n_tokens, np.int64)), pa.array(base), pa.array(score)]
            return pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, out)], schema=out)

        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i] for c in ("part", "lengths", "posts", "score", "base", "known")}
                if r["part"].as_py() != part:
                    if ids is not None:
                        yield finished()
                    part, ids = r["part"].as_py(), batch.column("ids")[i].values
                    lengths, held = unpacked(r["lengths"].as_py(), np.int64), unpacked(r["posts"].as_py(), np.uint8).astype(bool)
                    score, base, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids))
                    continue
                met = unpacked(r["posts"].as_py(), np.uint16)
                score[met] += unpacked(r["score"].as_py(), np.float64)
                base[met] += unpacked(r["base"].as_py(), np.float64)
                known[met] += unpacked(r["known"].as_py(), np.uint32)
        if ids is not None:
            yield finished()

    gathered = rows.repartition("part").sortWithinPartitions("part", F.col("ids").isNull())
    return gathered.mapInArrow(tidied(gather), result)


def perplexity(scored: DataFrame) -> DataFrame:
    """`held_out`, `perplexity` per token of the scored texts, in and out of the training text."""
    return scored.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))
