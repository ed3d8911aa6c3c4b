"""Exact Jaccard self-join of texts on word shingles, in the metric space of Jaccard distance.

A text is the set of its 5-word shingles (64-bit hashes); texts link at distance 0.2 or
less. Between unrelated texts every distance is 1, so texts picked as pivots for the whole
corpus would tell nothing apart. The space is cut in three steps instead, each exact:

1. Rings. The empty set as a pivot puts texts into rings by their size. Sizes of linked
   texts differ by a factor of 1.25 at most (triangle inequality), so a text near the
   outer edge of its ring is replicated into the next ring, and no other.
2. Regions. In a ring the universe of shingles is cut into slices by hash. Two linked
   texts of sizes a and b differ in at most (a + b) / 9 shingles, each of which spoils one
   slice, so of the k slices that a text fills at least k - (a + b) / 9 are the very same
   in the other. Texts with the same slice form a region; a text that shares fewer
   filled slices than that bound with anyone has no link and goes. Of its s shared slices
   a text keeps the s - bound + 1 that the fewest texts have: two linked texts keep the
   rarest of those they share, and a passage of many texts no longer holds them together.
   Regions with common texts make an area, which no link leaves.
3. Pivots. A small area is compared whole in one place. In a large one some texts are
   made pivots, and all others are compared with them: most fall into the cell of a pivot,
   at 0.2 or less. Rounds of pivots are repeated on what is left outside the largest
   component as long as that helps. The rest is compared with the texts of other
   components within the triangle-inequality windows of the area's first pivot,
   |d(x, p) - d(y, p)| <= 0.2, and of the empty set: cells of that width, whose members stay
   together in blocks, to which the rest is sent.

Texts with the same set count as one throughout. Nothing is sampled or capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from entidex.llm.common import importable, scratch, text_chunks, tidied, written
from entidex.storage import delete

#: Words of a shingle; linked at 100 * intersection >= 80 * union.
WORDS, SIMILAR = 5, 80
#: Least size that links with another (4 with 5), of the first ring, and the factor between rings.
SMALLEST, FIRST_RING, RING = 4, 5, 1.5
#: Slices of a ring beyond the differences that linked texts may have there.
SPARE = 1.3
#: Rows of a list of texts that may be sent to every task; longer lists are joined by shuffle.
SENT_ROWS = 1_000_000
#: Partners that meet a pivot in one task; more are dealt over several.
PARTNERS = 1_000
#: Shingles of an area that is compared whole, and of the sets that are compared with one
#: another in one place of a larger one.
AREA, BLOCK = 10_000, 1_000_000
#: Sets of one side of a place, of all and at least, that have a shingle counted by matrices;
#: entries of such a matrix and counts that are held at once besides those of that side.
FREQUENT, LEAST_FREQUENT, COUNTS = 1 / 4, 16, 500_000
#: Bytes of texts whose slices one task sorts, about 20 MB (60 where words have one letter); more make more shards.
SHARD_BYTES = 16_000_000
#: Pivots per area and round after the first, which takes one; another round follows if
#: this one left at most a share outside.
PIVOTS, PROGRESS = 4, 0.7

_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(WORDS)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: spreads all bits over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Shingle sets of texts; keeps the hashes of words it has met."""

    def __init__(self, kept_words: int = 100_000):
        self.kept: dict[bytes, int] = {}
        self.kept_words = kept_words

    def words(self, text: str) -> np.ndarray:
        found = text.encode("utf-8", "surrogatepass").lower().split()
        kept = self.kept
        if len(kept) > self.kept_words:
            kept.clear()
        for word in set(found).difference(kept):
            kept[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(kept.__getitem__, found), np.uint64, len(found))

    @staticmethod
    def places(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the words met, each word's place among them, and the words of each text.

        The same as `words` of all texts, which are cut and looked up at once. A hash may
        stand twice, should two words share it.
        """
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b" ".join(texts).lower(), np.uint8)
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts = edges[::2]
        # A text ends at the space that joins it with the next one.
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        lengths = np.diff(np.searchsorted(starts, ends), prepend=0)
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(edges[1::2] - starts, out=offsets[1:])
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.compress(inside[1:-1], data))]).dictionary_encode()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, found.dictionary.to_numpy(zero_copy_only=False)), np.uint64, len(found.dictionary))
        return hashes, found.indices.to_numpy(), lengths

    def set_of(self, text: str | None) -> np.ndarray:
        """Ascending hashes of the distinct shingles; a shorter text is one shingle."""
        words = self.words(text or "")
        n = len(words)
        if not n:
            return words
        size = min(WORDS, n)
        total = np.full(n - size + 1, size, np.uint64)
        for k in range(size):
            total = total + words[k : n - size + 1 + k] * _MULTIPLIERS[k]
        return np.unique(mixed(total))


def name_of(shingles: np.ndarray) -> int:
    """64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - 2**63


def ring_of(size: int) -> int:
    ring = 0
    while size >= ring_start(ring + 1):
        ring += 1
    return ring


def ring_start(ring: int) -> int:
    return round(FIRST_RING * RING**ring)


def slices_of(ring: int) -> int:
    """Slices of a ring: the most differences there, and some to spare."""
    return int(SPARE * 2 * ring_start(ring + 1) / 9) + 6


def rings_of(size: int) -> list[tuple[int, int]]:
    """(ring, most differences from a linked text) of each ring a set goes into.

    Sets below `SMALLEST` link with equal sets alone, so they go nowhere; those between it
    and the first ring link with larger ones alone, so they go into that ring.
    """
    if size < SMALLEST:
        return []
    largest = 5 * size // 4
    if size < FIRST_RING:
        return [(0, (size + largest) // 9)]
    ring = ring_of(size)
    after = ring_start(ring + 1)
    out = [(ring, (size + min(largest, after - 1)) // 9)]
    if largest >= after:
        out.append((ring + 1, (size + largest) // 9))
    return out


def signatures(shingles: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(ring, least number of shared slices, slice signatures) of a set, per ring."""
    out = []
    for ring, differences in rings_of(len(shingles)):
        n = slices_of(ring)
        spread = shingles * np.uint64(0x9E3779B97F4A7C15)
        at = ((spread >> np.uint64(32)) % np.uint64(n)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        content = np.add.reduceat(mixed(shingles[order] + np.uint64(1)), first)
        made = mixed(content + mixed(at[first].astype(np.uint64) + np.uint64(ring << 32)))
        least = len(first) - differences
        if least < 1:
            # Hardly any slice is filled alone: two such texts need not share one. They
            # meet by the least of their shingles, of which they must share one.
            head = shingles[: len(shingles) // 5 + 1]
            made = np.concatenate([made, mixed(head + np.uint64((ring + 1) << 40))])
            least = 1
        out.append((ring, least, made))
    return out


_BLOCKS = "shard int, signatures binary, starts binary, nodes binary, rings binary, least binary"
_DESCRIBED = "text_key bigint, node bigint, n_shingles bigint"
_REGIONS = "region bigint, ring int, least int"


def surveyed(docs: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    """Two kinds of rows, by one reading of the texts.

    One row per document: id, text_key, node (name of the set), n_shingles; region is null.
    And `region`, `ring`, `node`, `least`: members of every slice that several sets share.
    Signatures travel as blocks, one per chunk of texts and shard, not as rows.
    """
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    sent = T.StructType([*T.StructType.fromDDL(_BLOCKS).fields, id_field, *T.StructType.fromDDL(_DESCRIBED).fields])
    arrow = to_arrow_schema(sent)
    n_block = len(T.StructType.fromDDL(_BLOCKS))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for start, texts in text_chunks(batch.column(3)):
                names, sizes = [], []
                made, nodes, rings, leasts = [], [], [], []
                met = set()
                for text in texts:
                    shingles = shingler.set_of(text)
                    node = name_of(shingles) if len(shingles) else None
                    names.append(node)
                    sizes.append(len(shingles))
                    if len(shingles) < SMALLEST or node in met:
                        continue
                    met.add(node)
                    for ring, least, found in signatures(shingles):
                        # Slices of one set that look alike in 32 bits count once.
                        least = max(1, least - len(found) + len(np.unique(found.astype(np.uint32))))
                        made.append(found)
                        nodes.append(node)
                        rings.append(ring)
                        # Asking for fewer shared slices loses no link.
                        leasts.append(min(least, 65535))
                id_part, key_part, dealt = (batch.column(i).slice(start, len(texts)) for i in range(3))
                empty = [pa.nulls(len(texts), f.type) for f in list(arrow)[1:n_block]]
                own = [id_part.cast(arrow.field(n_block).type), key_part, pa.array(names, pa.int64()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays([dealt, *empty, *own], schema=arrow)
                if made:
                    yield pa.RecordBatch.from_pylist(blocks_of(made, np.array(nodes, np.int64), np.array(rings, np.uint8), np.array(leasts, np.uint16), shards), schema=arrow)

    # Described rows are dealt evenly, by id and text.
    dealt = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(1)), F.lit(shards)).cast("int")
    blocks = importable(docs).select(F.col(id_col), F.xxhash64(text_col).alias("text_key"), dealt.alias("dealt"), F.col(text_col)).mapInArrow(tidied(sign), sent)
    schema = T.StructType([id_field, *T.StructType.fromDDL(f"{_DESCRIBED}, {_REGIONS}").fields])
    out = to_arrow_schema(schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            described = batch.filter(batch.column(1).is_null())
            if described.num_rows:
                nothing = [pa.nulls(described.num_rows, f.type) for f in list(out)[4:]]
                yield pa.RecordBatch.from_arrays([*described.columns[n_block:], *nothing], schema=out)
            for row in batch.filter(batch.column(1).is_valid()).select(arrow.names[:n_block]).to_pylist():
                held.setdefault(row.pop("shard"), []).append(tuple(row.values()))
        for shard in list(held):
            blocks = held.pop(shard)
            made, nodes, rings, leasts = (np.concatenate([np.frombuffer(b[i], kind) for b in blocks]) for i, kind in ((0, np.uint32), (2, np.int64), (3, np.uint8), (4, np.uint16)))
            starts = np.concatenate([np.unpackbits(np.frombuffer(b[1], np.uint8), count=len(b[0]) // 4) for b in blocks])
            of = np.cumsum(starts, dtype=np.int64) - 1
            del blocks, starts
            nodes, rings, leasts = nodes[of], rings[of], leasts[of]
            order = np.lexsort((nodes, made, rings))
            made, nodes, rings, leasts = made[order], nodes[order], rings[order], leasts[order]
            same = (made[1:] == made[:-1]) & (rings[1:] == rings[:-1])
            fresh = np.append(True, ~(same & (nodes[1:] == nodes[:-1])))
            made, nodes, rings, leasts = made[fresh], nodes[fresh], rings[fresh], leasts[fresh]
            same = (made[1:] == made[:-1]) & (rings[1:] == rings[:-1])
            shared = np.append(same, False) | np.append(False, same)
            region = (np.int64(shard) << 40) | (rings[shared].astype(np.int64) << 32) | made[shared].astype(np.int64)
            columns = {"region": region, "ring": rings[shared].astype(np.int32), "node": nodes[shared], "least": leasts[shared].astype(np.int32)}
            for at in range(0, len(region), 200_000):
                n = len(region[at : at + 200_000])
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name][at : at + n]) if f.name in columns else pa.nulls(n, f.type) for f in out], schema=out)

    return blocks.repartitionById(shards, F.col("shard")).mapInArrow(tidied(meet), schema)


def blocks_of(made: list[np.ndarray], nodes: np.ndarray, rings: np.ndarray, leasts: np.ndarray, shards: int) -> list[dict]:
    """Signatures of sets by shard; name, ring and bound of a set stand once per block.

    starts: bits, set where the signatures of the next set begin.
    """
    by_ring = np.argsort(rings, kind="stable")
    made, nodes, rings, leasts = [made[i] for i in by_ring], nodes[by_ring], rings[by_ring], leasts[by_ring]
    of = np.repeat(np.arange(len(made)), [len(x) for x in made])
    made = np.concatenate(made)
    shard = ((made >> np.uint64(40)) % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.uint32)
    order = np.argsort(shard, kind="stable")
    made, of, shard = made[order].astype(np.uint32), of[order], shard[order]
    starts = np.append(True, (shard[1:] != shard[:-1]) | (of[1:] != of[:-1]))
    of = of[starts]
    cuts, sets = (np.searchsorted(x, np.arange(shards + 1)).tolist() for x in (shard, shard[starts]))
    return [
        {"shard": s, "signatures": made[a:b].tobytes(), "starts": np.packbits(starts[a:b]).tobytes(), "nodes": nodes[of[x:y]].tobytes(), "rings": rings[of[x:y]].tobytes(), "least": leasts[of[x:y]].tobytes()}
        for s, (a, b, x, y) in enumerate(zip(cuts[:-1], cuts[1:], sets[:-1], sets[1:]))
        if a < b
    ]


def viable(rows: DataFrame, folder: str) -> DataFrame:
    """Region rows of sets that share enough slices, one region per set of members.

    Each set stays in its rarest regions alone, as many as leave out one less than the least
    number it must share: of the regions of two linked sets the rarest is among these on both
    sides. So a slice that many texts share joins only those that have too little besides.
    """
    per_set, shares = Window.partitionBy("ring", "node"), F.count("*").over(Window.partitionBy("ring", "node"))
    members = F.count("*").over(Window.partitionBy("region"))
    rows = rows.withColumn("shares", shares).filter("shares >= least").drop("shares")
    rows = written(rows.withColumn("members", members).filter("members > 1"), folder, "viable-0")
    # The order is the same for all sets, as `members` belongs to the region.
    place = F.row_number().over(per_set.orderBy("members", "region"))
    rows = rows.withColumn("place", place).withColumn("shares", shares).filter("shares >= least and place <= shares - least + 1")
    # Of regions with the same members one is enough. As both sides of the join take all columns
    # of the same rows, one shuffle serves both.
    rows = rows.select("region", "ring", "node", "least").filter("region is not null").repartition("region")
    several = rows.groupBy("region").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("ring", "node", "least")).alias("content")).filter("members > 1")
    one = several.groupBy("content", "members").agg(F.min("region").alias("region")).select("region")
    return written(rows.join(one, "region"), folder, "viable-1")


def delivered(docs: DataFrame, text_col: str, nodes: DataFrame, targets: DataFrame, folder: str, name: str) -> DataFrame:
    """A text of each target node at its place: (g, a, b, side, node, mark, text), together and in order per place.

    targets: `node`, the place (g, a, b), `side` and `mark`. Texts travel, since they are
    smaller than their sets. Places are sorted by side, then node.
    """
    of = targets.groupBy("node").agg(F.collect_list(F.struct("g", "a", "b", "side", "mark")).alias("targets"))
    asked = written(nodes.select("node", "one").join(of, "node"), folder, f"asked-{name}", few=True)
    wanted = asked.select("node", F.col("one.text_key").alias("key_of"), F.col("one.id").alias("id_of"), "targets")
    if (asked.agg(F.sum(F.size("targets"))).first()[0] or 0) <= SENT_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.select("id", F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    # By the text's key, and of the texts with one key only that of the id: copies do not travel.
    found = texts.join(wanted, (F.col("text_key") == F.col("key_of")) & F.col("id").eqNullSafe(F.col("id_of")))
    placed = found.select(F.inline("targets"), "node", "text").select("g", "a", "b", "side", "node", "mark", "text")
    return importable(placed.repartition("g", "a", "b").sortWithinPartitions("g", "a", "b", "side", "node"))


def sets_of(batch: pa.RecordBatch, shingler: Shingler) -> Iterator[tuple[dict, np.ndarray]]:
    """Delivered rows with their sets; rows of another text under the same key are left out."""
    columns = {name: batch.column(name).to_pylist() for name in ("g", "a", "b", "side", "node", "mark")}
    texts = batch.column("text")
    for i in range(batch.num_rows):
        shingles = shingler.set_of(texts[i].as_py())
        if name_of(shingles) == columns["node"][i]:
            yield {name: values[i] for name, values in columns.items()}, shingles


def distances(docs: DataFrame, text_col: str, nodes: DataFrame, pairs: DataFrame, folder: str, name: str) -> DataFrame:
    """`pairs` (x, p) with `linked` and `distance`, by exact comparison of the sets.

    Every partner travels to its pivot; pivots with many partners are met in several places.
    """
    pairs = written(pairs, folder, f"pairs-{name}", few=True)
    places = pairs.groupBy("p").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("places"))
    rest = [F.lit(0).alias("b"), F.lit(None).cast("bigint").alias("mark")]
    to = pairs.join(places, "p").select(F.col("x").alias("node"), F.col("p").alias("g"), F.pmod(F.xxhash64("x"), "places").cast("int").alias("a"), F.lit(1).alias("side"), *rest)
    own = places.select(F.col("p").alias("node"), F.col("p").alias("g"), F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("a"), F.lit(0).alias("side"), *rest)
    result = "x bigint, p bigint, linked boolean, distance double"
    out = to_arrow_schema(T.StructType.fromDDL(result))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The pivot's own set comes first: one set is held at a time.
        place, own, last, shingler = None, None, None, Shingler()
        for batch in batches:
            rows = []
            for row, shingles in sets_of(batch, shingler):
                if row["side"] == 0:
                    place, own, last = (row["g"], row["a"]), shingles, None
                elif place == (row["g"], row["a"]) and row["node"] != last:
                    last = row["node"]
                    both = len(np.intersect1d(own, shingles, assume_unique=True))
                    union = len(own) + len(shingles) - both
                    rows.append({"x": last, "p": row["g"], "linked": 100 * both >= SIMILAR * union, "distance": 1 - both / union})
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    sent = delivered(docs, text_col, nodes, to.unionByName(own), folder, name)
    return written(sent.mapInArrow(tidied(compare), result), folder, f"distances-{name}")


def links_within(left: list[tuple[int, int, np.ndarray]], right: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """Links between two lists of (node, mark, set), as few as hold them together.

    Sets of one mark already hang together. Intersections are counted by a merged list of
    the shingles of `right`: no pair without a common shingle costs anything. Shingles that many
    sets of `right` have, as near copies do, are counted by a product of matrices instead.
    """
    root = {mark: mark for _, mark, _ in [*left, *right]}

    def find(mark: int) -> int:
        while root[mark] != mark:
            root[mark] = mark = root[root[mark]]
        return mark

    sizes = np.array([len(x) for _, _, x in right], np.int64)
    values = np.concatenate([x for _, _, x in right])
    owners = np.repeat(np.arange(len(right)), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    counts = np.diff(first, append=len(values))
    # At least a share FREQUENT of the matrix's entries is set: it stays in proportion to the sets.
    often = counts >= max(LEAST_FREQUENT, len(right) * FREQUENT)
    frequent = values[first[often]]
    dense = np.repeat(often, counts)
    has = np.zeros((len(right), len(frequent)), np.float32)
    has[owners[dense], np.searchsorted(frequent, values[dense])] = 1
    values, owners = values[~dense], owners[~dense]
    out, rows = [], max(1, COUNTS // max(len(right), len(frequent)))
    for at in range(0, len(left), rows):
        part = left[at : at + rows]
        asked = np.zeros((len(part), len(frequent)), np.float32)
        for row, (_, _, shingles) in zip(asked, part):
            row[np.isin(frequent, shingles, assume_unique=True)] = 1
        # Counts are exact in 32 bits, up to 2^24.
        for (node, mark, shingles), many in zip(part, asked @ has.T):
            low, high = np.searchsorted(values, shingles, "left"), np.searchsorted(values, shingles, "right")
            n = high - low
            both = many.astype(np.int64) + np.bincount(owners[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(right))
            for i in np.flatnonzero(100 * both >= SIMILAR * (len(shingles) + sizes - both)).tolist():
                a, b = find(mark), find(right[i][1])
                if a != b:
                    root[a] = b
                    out.append((node, right[i][0]))
    return out


def compared_blocks(docs: DataFrame, text_col: str, nodes: DataFrame, targets: DataFrame, folder: str, name: str) -> DataFrame:
    """Links (u, v) between the sets that meet at a place: side 0 with side 1, side 2 with all."""
    result = "u bigint, v bigint"
    out = to_arrow_schema(T.StructType.fromDDL(result))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, shingler = None, {}, Shingler()

        def finish() -> pa.RecordBatch:
            left = [(n, m, s) for (n, side), (m, s) in held.items() if side != 1]
            right = [(n, m, s) for (n, side), (m, s) in held.items() if side != 0]
            found = links_within(left, right) if left and right else []
            return pa.RecordBatch.from_pylist([{"u": u, "v": v} for u, v in found], schema=out)

        for batch in batches:
            for row, shingles in sets_of(batch, shingler):
                if (row["g"], row["a"], row["b"]) != place:
                    if held:
                        yield finish()
                    place, held = (row["g"], row["a"], row["b"]), {}
                held[row["node"], row["side"]] = row["mark"], shingles
        if held:
            yield finish()

    sent = delivered(docs, text_col, nodes, targets, folder, name)
    return written(sent.mapInArrow(tidied(run), result), folder, f"links-{name}")


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """`node`, `comp` of all nodes of the edges (u, v), by contracting to the least name.

    Names are hashes, so a round contracts a chain to a fraction of its length.
    """
    edges = written(edges.filter("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), folder, f"edges-{name}-0", few=True)
    labels = written(edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("comp", F.col("node")), folder, f"labels-{name}-0", few=True)
    step = 0
    while not edges.isEmpty():
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("to"))
        least = written(least, folder, f"least-{name}-{step}", few=True)
        moved = labels.join(least.select(F.col("u").alias("comp"), "to"), "comp", "left")
        labels = written(moved.select("node", F.coalesce("to", "comp").alias("comp")), folder, f"labels-{name}-{step}", few=True)
        a, b = least.select("u", F.col("to").alias("a")), least.select(F.col("u").alias("v"), F.col("to").alias("b"))
        edges = edges.join(a, "u").join(b, "v").filter("a != b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        edges = written(edges, folder, f"edges-{name}-{step}", few=True)
    return labels


def linked_components(docs: DataFrame, text_col: str, nodes: DataFrame, rows: DataFrame, folder: str) -> DataFrame:
    """`node`, `comp` of every set that has a link to a different set (and of some that have none).

    docs: `id` and the text. nodes: `node`, `one` (id and text_key of one of its texts),
    `n_shingles`; one row each. rows: the members of regions.
    """
    rows = viable(rows, folder)
    # Overlapping regions make one area; no link leaves it.
    least = rows.groupBy("region").agg(F.min("node").alias("v"))
    area = components(rows.join(least, "region").select(F.col("node").alias("u"), "v"), folder, "areas").withColumnRenamed("comp", "area")
    degree = rows.groupBy("node").agg(F.count("*").alias("degree"))
    members = area.join(degree, "node").join(nodes.select("node", "n_shingles"), "node")
    weight = members.groupBy("area").agg(F.sum("n_shingles").alias("weight"))
    members = written(members.join(weight, "area"), folder, "members", few=True)

    # Small areas are compared whole, each in one place.
    small = members.filter(F.col("weight") <= AREA)
    targets = small.select("node", F.col("area").alias("g"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(2).alias("side"), F.col("node").alias("mark"))
    edges = compared_blocks(docs, text_col, nodes, targets, folder, "small")
    large = members.filter(F.col("weight") > AREA)
    if not large.isEmpty():
        edges = edges.unionByName(_large_areas(docs, text_col, nodes, written(large, folder, "large", few=True), folder))
    return components(edges, folder, "all")


def _large_areas(docs: DataFrame, text_col: str, nodes: DataFrame, members: DataFrame, folder: str) -> DataFrame:
    """Links (u, v) of areas that are too large for one place: first by pivots, then by windows."""
    edges, known, before, step = None, None, None, 0
    while True:
        # A round of pivots: first the best connected, then such outside the largest component.
        if edges is None:
            now = members.withColumn("comp", F.col("node"))
            outside = now
        else:
            labels = components(edges, folder, f"large-{step}")
            now = members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            parts = now.groupBy("area", "comp").agg(F.count("*").alias("n"))
            main = parts.groupBy("area").agg(F.max(F.struct("n", "comp")).alias("main")).select("area", F.col("main.comp").alias("main"))
            now = written(now.join(main, "area"), folder, f"now-{step}", few=True)
            outside = now.filter("comp != main")
            left, heaviest = outside.groupBy("area").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w")).agg(F.sum("n"), F.max("w")).first()
            if not left:
                return edges
            if heaviest <= BLOCK or before is not None and left > PROGRESS * before:
                break
            before = left
        best = outside.groupBy("area", "comp").agg(F.max(F.struct("degree", "node", "n_shingles")).alias("of"))
        order = F.row_number().over(Window.partitionBy("area").orderBy(F.desc("of")))
        # Of each area at most PIVOTS rows are kept, a limit that is applied before the rows meet.
        pivots = best.withColumn("r", order).filter(F.col("r") <= (PIVOTS if step else 1)).select("area", F.col("comp").alias("p_comp"), F.col("of.node").alias("p"), F.col("of.n_shingles").alias("p_size"), "r")
        pivots = written(pivots, folder, f"pivots-{step}", few=True)
        sizes_fit = 5 * F.least("n_shingles", "p_size") >= 4 * F.greatest("n_shingles", "p_size")
        met = now.join(F.broadcast(pivots) if pivots.count() <= SENT_ROWS else pivots, "area")
        met = met.filter((F.col("comp") != F.col("p_comp")) & (sizes_fit | (F.col("r") == 1)))
        found = distances(docs, text_col, nodes, met.select(F.col("node").alias("x"), "p").distinct(), folder, f"large-{step}")
        if known is None:
            # Distance of every member to the first pivot of its area, which is at 0.
            to_first = found.join(pivots.filter("r = 1").select("p", "area"), "p").select(F.col("x").alias("node"), "distance")
            own = pivots.filter("r = 1").select(F.col("p").alias("node"), F.lit(0.0).alias("distance"))
            known = written(to_first.unionByName(own), folder, "known", few=True)
        linked = found.filter("linked").select(F.col("x").alias("u"), F.col("p").alias("v"))
        edges = linked if edges is None else edges.unionByName(linked)
        step += 1

    # What is outside meets the members of other components within its windows. Distances to
    # the pivot and sizes are cut into cells as wide as links reach, and cells meet their neighbours.
    width, ratio = (100 - SIMILAR) / 100 + 1e-9, math.log(100 / SIMILAR) + 1e-9
    cell = ["area", "class", "band"]
    now = now.join(known, "node").withColumn("band", F.floor(F.col("distance") / width).cast("int")).withColumn("class", F.floor(F.log("n_shingles") / ratio).cast("int"))
    cells = now.groupBy(cell).agg(F.sum("n_shingles").alias("weight"), F.sum(F.when(F.col("comp") != F.col("main"), F.col("n_shingles"))).alias("out_weight"))
    cells = written(cells, folder, "cells", few=True)
    near = lambda name: F.explode(F.array(*(F.col(name) + d for d in (-1, 0, 1))))
    pairs = cells.filter("out_weight > 0").select("area", F.col("class").alias("from_class"), F.col("band").alias("from_band"), "out_weight")
    pairs = pairs.withColumn("class", near("from_class")).withColumn("band", near("from_band")).join(cells.select(cell), cell)
    # Members stay together in blocks: small cells are packed, in order, and large ones are cut.
    light = F.when(2 * F.col("weight") < BLOCK, F.col("weight")).otherwise(0)
    before = F.sum(light).over(Window.partitionBy("area").orderBy("class", "band")) - light
    number = F.when(light > 0, F.floor(2 * before / BLOCK)).otherwise((8 * F.col("class") + F.col("band") + 1) * F.lit(1 << 20))
    blocks = cells.join(pairs.select(cell).distinct(), cell).withColumn("first", number.cast("int")).withColumn("parts", F.when(light > 0, 1).otherwise(F.ceil(F.col("weight") / BLOCK)).cast("int"))
    blocks = written(blocks.select(*cell, "first", "parts"), folder, "blocks", few=True)
    # A member goes into one block; what is outside goes to all blocks within its windows.
    aims = pairs.join(blocks, cell).withColumn("a", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)))
    aims = aims.select("area", F.col("from_class").alias("class"), F.col("from_band").alias("band"), "a", "out_weight").distinct()
    aims = written(aims, folder, "aims", few=True)
    places = aims.groupBy("area", "a").agg(F.ceil(F.sum("out_weight") / BLOCK).cast("int").alias("places"))
    part = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    outs = now.filter("comp != main").join(aims.drop("out_weight"), cell).join(places, ["area", "a"]).withColumn("b", part("places")).withColumn("side", F.lit(0))
    alls = now.join(blocks, cell).withColumn("a", F.col("first") + part("parts")).join(places, ["area", "a"])
    alls = alls.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("places") - 1))).withColumn("side", F.lit(1))
    target = ["node", F.col("area").alias("g"), "a", "b", F.col("comp").alias("mark"), "side"]
    # One text is enough where it comes from both sides.
    targets = outs.select(target).unionByName(alls.select(target)).groupBy("node", "g", "a", "b", "mark").agg(F.when(F.min("side") < F.max("side"), 2).otherwise(F.min("side")).alias("side"))
    return edges.unionByName(compared_blocks(docs, text_col, nodes, targets, folder, "large"))


def _joined(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of `join_texts` as `id`, `text_key`, `n_shingles`, `component_id`, `first` (id and text_key of the group's row that stays)."""
    spark = docs.sparkSession
    folder, work = scratch(spark), scratch(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    survey = written(surveyed(docs, "id", "text", shards), work, "survey")
    all_rows = written(survey.filter("region is null").select("id", "text_key", "node", "n_shingles"), folder, "described")
    nodes = all_rows.filter("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.min(F.struct("id", "text_key")).alias("one"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "text_key"))).alias("first"), F.first("n_shingles").alias("n_shingles"))
    nodes = written(nodes, folder, "nodes")
    rows = survey.filter("region is not null").select("region", "ring", "node", "least")
    labels = written(linked_components(docs, "text", nodes, rows, work), folder, "labels", few=True)
    delete(spark, work)
    named = nodes.join(labels, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"), "id", "first")
    least = named.groupBy("comp").agg(F.min("id").alias("component_id"), F.min("first").alias("first"))
    of = named.select("node", "comp").join(least, "comp").select("node", "component_id", "first")
    out = all_rows.join(of, "node", "left")
    return out.select("id", "text_key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), F.when(F.col("n_shingles") > 0, F.col("first")).alias("first"))


def join_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: `id_col`, `n_shingles`, `component_id` (least id reachable by links).

    Equal sets are linked. A null, empty or blank text has no shingles and links with
    nothing: its component is its own id. Of repeated ids the rows stand for themselves. A
    null id is no name for a component but passes links on. Other columns are not read.
    """
    found = _joined(docs, id_col, text_col)
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each group: the one with the least id, then text hash.

    Rows without shingles are groups of their own and all stay, as do rows without id.
    Of rows that repeat an id and its text one stays.
    """
    found = written(_joined(docs, id_col, text_col), scratch(docs.sparkSession), "joined")
    if not found.filter("id is not null").groupBy("id").count().filter("count > 1").isEmpty():
        named = docs.filter(docs[id_col].isNotNull()).dropDuplicates([id_col, text_col])
        docs = named.unionByName(docs.filter(docs[id_col].isNull()))
    # By id and text: another text of the same id may be the one row of its group.
    other = (F.col("first.id") != F.col("id")) | (F.col("first.text_key") != F.col("text_key"))
    dropped = found.filter(F.col("id").isNotNull() & other).select(F.col("id").alias("__dropped"), F.col("text_key").alias("__text_key")).distinct()
    if dropped.limit(SENT_ROWS + 1).count() <= SENT_ROWS:
        dropped = F.broadcast(dropped)
    same = docs[id_col].eqNullSafe(F.col("__dropped")) & F.xxhash64(docs[text_col]).eqNullSafe(F.col("__text_key"))
    return docs.join(dropped, same, "left_anti")
