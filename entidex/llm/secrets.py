"""Secret scan by assignment-aware lexing.

Three plain patterns give the base findings. On top of them, texts that hold an
assignment sign are lexed as source or configuration: names, string literals, bare
values, operators. Name-literal pairs are read off the tokens, constants are propagated
(`A = "x"; token = A`, and parts joined by `+`), in comments too, and each literal is scored by how
sensitive the name is that it ends up under and by how random it looks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from entidex.llm.common import SPANS, map_texts, replace_texts, span_array, span_digest

#: The base patterns and the least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex")

#: Weight of the words a name is made of; the whole name scores the largest sum of one group.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.6,
    "secret": 1.0, "token": 1.0, "credential": 0.9, "credentials": 0.9, "apikey": 1.0,
    "api": 0.4, "access": 0.4, "private": 0.5, "auth": 0.5, "key": 0.5, "signing": 0.4,
    "encryption": 0.4, "client": 0.2, "bearer": 0.6, "session": 0.2,
}
#: Words of a name or literal that speak against a secret.
HARMLESS_NAME = {"name", "file", "path", "url", "id", "length", "size", "count", "type", "field", "public", "hint", "expiry", "ttl"}
PLACEHOLDER = re.compile(r"(?i)(.)\1{5,}|change.?me|example|placeholder|your[-_ ]|dummy|redacted|todo|^(none|null|true|false|undefined)$|^[$%<{]|[}>]$")

#: Least score of a literal, and its least length.
LEAST_SCORE, LEAST_LENGTH = 1.0, 8

#: A constant that stands in a sum counts with at most so many literals and code points in all;
#: longer sums end there. Literals written out in a sum, and a constant alone, have no bound.
MOST_PARTS, LONGEST_SUM = 32, 512

TOKEN = re.compile(
    r"""(?P<space>[\x20\t]+)|(?P<comment>(?<!:)//|\#(?=\s)|(?<![^\n])\#)|(?P<line>\n)|(?P<op>:=|=>|==|!=|<=|>=|[=:+,;(){}\[\]|])"""
    r"""|(?P<quote>(?<![A-Za-z0-9])["'])|(?P<word>[^\s"'=:+,;(){}\[\]|]+)|(?P<other>.)""",
    re.DOTALL,
)
#: A quote with the backslashes before it, and the end of a line.
MARK = re.compile(r"""(\\*)(["'])|\n""")
NAME = re.compile(r"[A-Za-z_$@][\w.$-]*\Z", re.ASCII)
ASSIGNS = {"=", ":", ":=", "=>"}


def name_score(name: str) -> float:
    """How sensitive a target name is, from the words it is made of."""
    words = [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", name)]
    if not words or words[-1] in HARMLESS_NAME or "public" in words:
        return 0.0
    return min(1.5, sum(SENSITIVE.get(w, 0.0) for w in set(words)))


def literal_score(value: str) -> float:
    """How random a literal looks: from 0 for words and placeholders to 1."""
    if len(value) < LEAST_LENGTH or PLACEHOLDER.search(value) or " " in value:
        return 0.0
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    kinds = sum(any(test(c) for c in value) for test in (str.isdigit, str.islower, str.isupper, lambda c: not c.isalnum()))
    return min(1.0, bits / 4 * (0.7 + 0.15 * kinds))


class Pair:
    """One assignment: the target's name, the resolved value and where its literals lie."""

    __slots__ = ("name", "value", "spans")

    def __init__(self, name: str, value: str, spans: tuple[tuple[int, int], ...]):
        self.name, self.value, self.spans = name, value, spans


def closing_quotes(text: str) -> dict[int, int]:
    """Where the literal ends that a quote would open: the next quote of its kind in its line that is not escaped.

    Backslashes before a quote reach back to no other quote, so whether one is escaped does
    not depend on where a literal began. One pass from the end finds all.
    """
    ends: dict[int, int] = {}
    following: dict[str, int] = {}
    for m in reversed(list(MARK.finditer(text))):
        if m.group(2) is None:
            following.clear()
            continue
        at, quote = m.end() - 1, m.group(2)
        if quote in following:
            ends[at] = following[quote]
        if len(m.group(1)) % 2 == 0:
            following[quote] = at
    return ends


def lexed(text: str) -> list[tuple[str, str, int]]:
    """(kind, token, start) of a text but its blanks, in time linear in its length."""
    ends, out, at = closing_quotes(text), [], 0
    match, size = TOKEN.match, len(text)
    while at < size:
        m = match(text, at)
        kind, start, at = m.lastgroup, at, m.end()
        if kind == "space":
            continue
        if kind == "quote":
            end = ends.get(start)
            kind, at = ("other", at) if end is None else ("text", end + 1)
        out.append((kind, text[start:at], start))
    return out


def pairs(text: str) -> Iterator[Pair]:
    """Name-literal pairs of a text, in order, constants propagated.

    Comments are lexed like the rest; their constants hold in comments alone.
    """
    tokens = lexed(text)
    known: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
    noted: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
    commented = False

    def operand(i: int, last: bool):
        """Value and spans of the operand at token i, and whether it is a constant; a bare word only where it may be a literal."""
        kind, word, at = tokens[i]
        if kind == "text":
            return word[1:-1], ((at + 1, at + len(word) - 1),), False
        if kind == "word":
            if commented and word in noted:
                return *noted[word], True
            if word in known:
                return *known[word], True
            if not last or any(c.isdigit() for c in word):
                return word, ((at, at + len(word)),), False
        return None

    for i in range(1, len(tokens) - 1):
        if tokens[i - 1][0] in ("comment", "line"):
            commented = tokens[i - 1][0] == "comment"
        if tokens[i][0] != "op" or tokens[i][1] not in ASSIGNS:
            continue
        kind, word, _ = tokens[i - 1]
        name = word[1:-1] if kind == "text" else word
        if kind not in ("text", "word") or not NAME.match(name):
            continue
        if tokens[i][1] == ":" and text.startswith("//", tokens[i][2] + 1):
            continue  # the scheme of a URL
        found = operand(i + 1, False)
        if found is None:
            continue
        value, spans, constant = found
        values, n_places, length, places, j = [value], len(spans), len(value), [spans], i + 2
        while j + 1 < len(tokens) and tokens[j][:2] == ("op", "+"):
            more = operand(j + 1, True)
            if more is None:
                break
            constant |= more[2]
            n_places, length = n_places + len(more[1]), length + len(more[0])
            if constant and (n_places > MOST_PARTS or length > LONGEST_SUM):
                break
            values.append(more[0])
            places.append(more[1])
            j += 2
        if len(values) > 1:
            value, spans = "".join(values), tuple(chain.from_iterable(places))
        (noted if commented else known)[name] = value, spans
        yield Pair(name, value, spans)


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Literals whose names and looks score enough, as (kind, start, end)."""
    if "=" not in text and ":" not in text:
        return []
    found = set()
    #: Pair, score and whether it was found, of long values by their spans' object: any number
    #: of lines may assign the same one.
    long: dict[int, tuple[Pair, float, bool]] = {}
    for pair in pairs(text):
        weight = name_score(pair.name)
        if weight < 0.5:
            continue
        is_long = len(pair.value) > LONGEST_SUM or len(pair.spans) > MOST_PARTS
        _, score, done = long.get(id(pair.spans), (pair, None, False)) if is_long else (pair, None, False)
        score = literal_score(pair.value) if score is None else score
        good = weight + score - 0.5 >= LEAST_SCORE
        if good and not done:
            found |= {("literal", s, e) for s, e in pair.spans if e > s}
        if is_long:
            long[id(pair.spans)] = pair, score, good or done
    return sorted(found, key=lambda s: s[1:])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


_ORDER = {kind: i for i, kind in enumerate((*KINDS, "literal"))}


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind as listed, then end."""
    text = text or ""
    return sorted(base_spans(text) + literal_spans(text), key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col` and `spans` (kind, start, end in code points, end exclusive) of every row.

    Kinds: assign, access, hex (base) and literal (by lexing). A null or empty text has no
    spans; repeated rows repeat; an empty table gives none; other columns are not read.
    """
    make = lambda: lambda texts: [span_array([scan(t) for t in texts])]
    return map_texts(docs, id_col, text_col, make, f"spans {SPANS}")


def blank(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each union of spans replaced by `[SECRET]`."""
    if not spans:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for _, start, end in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[at:start], "[SECRET]"]
        at = end
    return "".join(out) + text[at:]


def remove_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with every finding blanked; null texts stay null, other columns as they are."""
    return replace_texts(docs, text_col, lambda: lambda texts: [blank(t, scan(t)) for t in texts])


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, *span_digest("spans", KINDS, ("n_assign", "n_access", "n_hex")))
