"""Byte-level BPE encoding and decoding over whole texts.

Per short word the codec holds the parts between the boundaries and, in a second
contiguous array, the rank of every adjacent pair. It scans the ranks for the minimum,
deletes that boundary and refreshes the two neighbouring ranks, until no pair has a
rank. Scanning costs the square of the length, so words above `SHORT` bytes take a heap
over the same ranks instead; both give the same parts.

Words repeat, so each Python worker keeps the words it has met, in two generations of
bounded size.
"""

from __future__ import annotations

import functools
import heapq
import json
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entidex.llm.common import map_texts

#: Fixed value: the split of byte-level BPE into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Longest word, in bytes, whose ranks are scanned.
SHORT = 64
#: Words a worker keeps per generation.
KEPT_WORDS = 150_000

_BITS = 20
_LOW = (1 << _BITS) - 1
_NONE = 1 << 62


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    stand for themselves, the rest take the code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Codec:
    """Encodes and decodes as the given tokenizer file says (byte-level BPE only)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE")
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        vocab = model["vocab"]
        self.first = [vocab[letter] for letter in letters]
        self.pairs = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault(vocab[left] << _BITS | vocab[right], rank << _BITS | vocab[left + right])
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: token.encode() for token, i in self.added.items()}
        self.added_split = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.words = regex.compile(WORDS)
        self.kept: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        parts = [self.first[b] for b in word]
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        rank = self.pairs.get
        ranks = [rank(a << _BITS | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [least & _LOW]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << _BITS | parts[i], _NONE)
            if i < len(ranks):
                ranks[i] = rank(parts[i] << _BITS | parts[i + 1], _NONE)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        rank, n = self.pairs.get, len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r >> _BITS, i, r & _LOW) for i in range(n - 1) if (r := rank(parts[i] << _BITS | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, made = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or rank(parts[i] << _BITS | parts[j], _NONE) & _LOW != made:
                continue
            parts[i], parts[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0 and (r := rank(parts[left] << _BITS | parts[after[left]])) is not None:
                    heapq.heappush(heap, (r >> _BITS, left, r & _LOW))
        return [p for p in parts if p >= 0]

    def _entry(self, word: str) -> tuple[bytes, bytes]:
        entry = self.older.get(word)
        if entry is None:
            ids = self.merge(word.encode())
            entry = struct.pack(f"<{len(ids)}i", *ids), self.decode_bytes(ids)
        if len(self.kept) >= KEPT_WORDS:
            self.older, self.kept = self.kept, {}
        self.kept[word] = entry
        return entry

    def entries(self, text: str) -> list[tuple[bytes, bytes]]:
        """(packed ids, decoded bytes) of each word, in order."""
        out, start = [], 0
        for found in self.added_split.finditer(text) if self.added_split else ():
            out += self._plain(text[start : found.start()])
            token = self.added[found.group()]
            out.append((struct.pack("<i", token), self.bytes_of[token]))
            start = found.end()
        return out + self._plain(text[start:])

    def _plain(self, text: str) -> list[tuple[bytes, bytes]]:
        get, make = self.kept.get, self._entry
        out = []
        for word in self.words.findall(text):
            entry = get(word)
            if entry is None:
                entry = make(word)
                get = self.kept.get
            out.append(entry)
        return out

    def encode(self, text: str) -> list[int]:
        packed = b"".join([e[0] for e in self.entries(text)])
        return list(struct.unpack(f"<{len(packed) // 4}i", packed))

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of.get(i, b"") for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, `ids` array<int> and `decoded`, the text made from the ids again.

    path: a byte-level BPE file that every executor can open. A null text counts as
    empty and gives no ids and an empty text; repeated rows give repeated results; an
    empty table gives none. Other columns are not read, so their names cannot clash.
    """

    def make():
        bpe = codec(path)

        def apply(texts: list) -> list[pa.Array]:
            ids, ends, decoded = [], [0], []
            for text in texts:
                entries = bpe.entries(text or "")
                ids.append(b"".join([e[0] for e in entries]))
                ends.append(ends[-1] + len(ids[-1]) // 4)
                decoded.append(b"".join([e[1] for e in entries]).decode("utf-8", "replace"))
            flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array(decoded, pa.string())]

        return apply

    return map_texts(docs, id_col, text_col, make, "ids array<int>, decoded string")


def decode(frame: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`id_col` and `decoded`: the text of stored ids. Null ids count as none."""

    def make():
        bpe = codec(path)
        return lambda rows: [pa.array([bpe.decode(ids or []) for ids in rows], pa.string())]

    return map_texts(frame, id_col, ids_col, make, "decoded string")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token count and hashes of ids and decoded text."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
