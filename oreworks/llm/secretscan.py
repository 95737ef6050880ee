"""Secrets in texts by an inverted index of trigrams: Boolean queries from the rules, then verification.

From the pattern of each rule follows which trigrams a text must have for a match, as a tree of
"all of" and "one of". The texts of a task's slice are a shard with an index of its own: for each
trigram that some rule asks for, the sorted numbers of the texts that have it. Intersections and
unions of these postings leave the texts that a rule can match; only those are searched. A rule
without a mandatory trigram searches every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.shared import row_schema, text_slices, whole_row


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters, leftmost first.

    The pattern is over UTF-8 bytes and may match ASCII characters only. Matches don't overlap;
    one that is too short takes up its place all the same.
    """

    kind: str
    pattern: bytes
    group: int = 0
    least: int = 0


# The kinds of secrets, in the order in which they are listed.
BASE_RULES = (
    Rule(
        "assign",
        rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", rb"AKIA[A-Z0-9]+", least=18),
    # A run of hex digits is matched whole or not at all, so the length can stand in the pattern.
    Rule("hex", rb"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("pem", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub", rb"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat", rb"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

#: Strings that an exact set may hold, and their length, before it becomes a query.
EXACT_STRINGS, EXACT_LENGTH = 64, 12
#: Characters of a class that are told apart.
CLASS_CHARACTERS = 8
#: Bytes of a shard's texts whose trigrams are made at a time.
INDEX_BYTES = 4 << 20

#: A query: ``None`` (any text), a trigram, or ``("and" | "or", parts)``.
Query = int | tuple | None


def _fold(text: bytes) -> bytes:
    """The index knows A-Z as a-z only, so a query holds for patterns of either kind."""
    return text.lower()


def _combined(kind: str, parts: Iterable[Query]) -> Query:
    found: set[Query] = set()
    for p in parts:
        found |= p[1] if isinstance(p, tuple) and p[0] == kind else {p}
    return next(iter(found)) if len(found) == 1 else (kind, frozenset(found))


def both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a if b is None else b
    return _combined("and", (a, b))


def either(parts: Iterable[Query]) -> Query:
    found = list(parts)
    return None if not found or None in found else _combined("or", found)


def _of_string(text: bytes) -> Query:
    """All trigrams of a string that stands in the text."""
    query: Query = None
    for a, b, c in zip(text, text[1:], text[2:], strict=False):
        query = both(query, a << 16 | b << 8 | c)
    return query


@dataclass(frozen=True)
class _Part:
    """What is known of the matches of a part of a pattern: all of them, or their ends and a query."""

    exact: frozenset[bytes] | None
    prefixes: frozenset[bytes]
    suffixes: frozenset[bytes]
    query: Query


_NONE = frozenset((b"",))
_ANY = _Part(None, _NONE, _NONE, None)


def _exact(strings: Iterable[bytes]) -> _Part:
    found = frozenset(strings)
    part = _Part(found, found, found, None)
    return part if len(found) <= EXACT_STRINGS and max(map(len, found)) <= EXACT_LENGTH else _open(part)


def _open(part: _Part) -> _Part:
    """The part without its exact set, whose trigrams go into the query."""
    if part.exact is None:
        return part
    return _Part(
        None,
        frozenset(s[:2] for s in part.exact),
        frozenset(s[-2:] for s in part.exact),
        either(_of_string(s) for s in part.exact),
    )


def _joined(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None:
        return _exact(x + y for x, y in product(a.exact, b.exact))
    across = either(_of_string(x[-2:] + y[:2]) for x, y in product(a.suffixes, b.prefixes))
    first = frozenset((x + y)[:2] for x, y in product(a.exact, b.prefixes)) if a.exact is not None else a.prefixes
    last = frozenset((x + y)[-2:] for x, y in product(a.suffixes, b.exact)) if b.exact is not None else b.suffixes
    a, b = _open(a), _open(b)
    return _Part(None, first, last, both(both(a.query, b.query), across))


def _one_of(parts: Sequence[_Part]) -> _Part:
    if all(p.exact is not None for p in parts):
        return _exact(frozenset().union(*(p.exact for p in parts)))
    opened = [_open(p) for p in parts]
    first = frozenset().union(*(p.prefixes for p in opened))
    last = frozenset().union(*(p.suffixes for p in opened))
    return _Part(None, first, last, either(p.query for p in opened))


def _class(items: list) -> _Part:
    found: set[bytes] = set()
    for op, value in items:
        if str(op) == "LITERAL":
            found.add(_fold(bytes([value])))
        elif str(op) == "RANGE" and value[1] - value[0] < CLASS_CHARACTERS:
            found.update(_fold(bytes([c])) for c in range(value[0], value[1] + 1))
        else:
            return _ANY
    return _exact(found) if len(found) <= CLASS_CHARACTERS else _ANY


def _analysed(tree) -> _Part:
    known = _exact(_NONE)
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            part = _exact((_fold(bytes([value])),))
        elif name == "IN":
            part = _class(value)
        elif name == "BRANCH":
            part = _one_of([_analysed(t) for t in value[1]])
        elif name in ("SUBPATTERN", "ATOMIC_GROUP"):
            part = _analysed(value[-1] if name == "SUBPATTERN" else value)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = value
            once = _analysed(inner)
            if (least, most) == (1, 1):
                part = once
            elif least == 0:
                part = _one_of([once, _exact(_NONE)]) if most == 1 else _ANY
            else:
                opened = _open(once)
                part = _Part(None, opened.prefixes, opened.suffixes, opened.query)
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue  # takes no character, and only narrows the matches
        else:
            part = _ANY
        known = _joined(known, part)
    return known


def trigram_query(pattern: bytes) -> Query:
    """The trigrams, in lower case, that every text with a match has; ``None`` if none is mandatory."""
    return _open(_analysed(re._parser.parse(pattern))).query


def trigrams_of(query: Query) -> set[int]:
    if query is None:
        return set()
    return {query} if not isinstance(query, tuple) else set().union(*map(trigrams_of, query[1]))


class ShardIndex:
    """Postings of the wanted trigrams over the texts of one shard."""

    def __init__(self, texts: Sequence[bytes], wanted: np.ndarray) -> None:
        self.n = len(texts)
        keys: list[np.ndarray] = []
        held: list[int] = []
        size = 0
        for number, text in enumerate(texts):
            if len(text) > INDEX_BYTES:
                for at in range(0, len(text) - 2, INDEX_BYTES):
                    keys.append(self._keys([text[at : at + INDEX_BYTES + 2]], [number], wanted))
                continue
            held.append(number)
            size += len(text)
            if size > INDEX_BYTES:
                keys.append(self._keys([texts[i] for i in held], held, wanted))
                held, size = [], 0
        if held:
            keys.append(self._keys([texts[i] for i in held], held, wanted))
        found = np.unique(np.concatenate(keys)) if keys else np.zeros(0, dtype=np.int64)
        trigrams = found >> 32
        edges = [0, *(np.flatnonzero(trigrams[1:] != trigrams[:-1]) + 1).tolist(), len(found)]
        numbers = found & 0xFFFFFFFF
        self.postings = {int(trigrams[a]): numbers[a:b] for a, b in pairwise(edges) if b > a}

    @staticmethod
    def _keys(texts: list[bytes], numbers: list[int], wanted: np.ndarray) -> np.ndarray:
        """Trigram and number of its text, each pair once."""
        a = np.frombuffer(_fold(b"".join(texts)), dtype=np.uint8).astype(np.int32)
        if len(a) < 3:
            return np.zeros(0, dtype=np.int64)
        codes = a[:-2] << 16 | a[1:-1] << 8 | a[2:]
        at = np.flatnonzero(wanted[codes])
        ends = np.cumsum([len(t) for t in texts])
        owner = np.searchsorted(ends, at, side="right")
        inside = at + 2 < ends[owner]
        return np.unique(codes[at[inside]].astype(np.int64) << 32 | np.array(numbers, dtype=np.int64)[owner[inside]])

    def candidates(self, query: Query) -> np.ndarray:
        """Numbers of the texts that meet a query, in order."""
        if query is None:
            return np.arange(self.n)
        if not isinstance(query, tuple):
            return self.postings.get(query, np.zeros(0, dtype=np.int64))
        kind, parts = query
        if kind == "or":
            return np.unique(np.concatenate([self.candidates(p) for p in parts]))
        # The shortest postings first, so that the rest is looked up in few.
        lists = sorted((self.candidates(p) for p in parts), key=len)
        found = lists[0]
        for other in lists[1:]:
            if not len(found):
                break
            found = found[np.isin(found, other, assume_unique=True)]
        return found


def _matches(rule: Rule, compiled: re.Pattern, text: bytes) -> Iterator[tuple[int, int]]:
    for m in compiled.finditer(text):
        start, end = m.span(rule.group)
        if end - start >= rule.least:
            yield m.span()


def _in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans ``(start, kind, end)`` in bytes as spans in code points, in one pass over the text."""
    if text.isascii() or not spans:
        return spans
    begins = np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)
    at = lambda b: int(begins[b - 1]) if b else 0
    return [(at(start), kind, at(end)) for start, kind, end in spans]


def _scanned(rules: Sequence[Rule], text_col: str):
    queries = [trigram_query(r.pattern) for r in rules]
    asked = sorted(set().union(*map(trigrams_of, queries)))
    kinds = pa.array([r.kind for r in rules])
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << 24, dtype=bool)
        wanted[asked] = True
        compiled = [re.compile(r.pattern) for r in rules]
        for batch in batches:
            for part, texts in text_slices(batch, text_col):
                index = ShardIndex(texts, wanted)
                found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                for place, (rule, pattern, query) in enumerate(zip(rules, compiled, queries, strict=True)):
                    for number in index.candidates(query).tolist():
                        found[number] += [(a, place, b) for a, b in _matches(rule, pattern, texts[number])]
                ordered = [_in_code_points(t, sorted(f)) for t, f in zip(texts, found, strict=True)]
                flat = [s for spans in ordered for s in spans]
                starts, at, ends = zip(*flat, strict=True) if flat else ((), (), ())
                made = pa.StructArray.from_arrays(
                    [kinds.take(pa.array(at, pa.int32())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                    fields=list(span),
                )
                offsets = np.cumsum([0, *map(len, ordered)], dtype=np.int32)
                spans = pa.ListArray.from_arrays(pa.array(offsets), made)
                yield pa.RecordBatch.from_arrays([part.column("row"), spans], ["row", "spans"])

    return run


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """``row`` (the input's columns) and ``spans`` of every row: ``kind``, ``start``, ``end`` of each secret.

    Bounds count code points of the whole text, the end exclusive; spans stand in the order of their
    start, then of the rules. Spans of different kinds may overlap. A null or empty text has none.
    Rows stay where they are and nothing is shuffled; equal rows have equal results, an empty table
    gives none. Very long texts are indexed piece by piece and are a shard of their own.
    """
    schema = row_schema(docs, "spans array<struct<kind:string,start:int,end:int>>")
    return docs.select(whole_row(docs)).mapInArrow(_scanned(tuple(rules), text_col), schema)


def redacted(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with ``mark`` in the place of each secret; overlapping ones are one. Columns stay."""
    found = find_secrets(docs, rules, text_col)
    text = F.col("row")[text_col]
    # What is done so far, and how far the text is copied.
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state, s):
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        apart = F.concat(state["done"], gap, F.lit(mark))
        return F.struct(
            F.when(s["start"] >= state["at"], apart).otherwise(state["done"]).alias("done"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    cut = F.aggregate("spans", start, step, lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.char_length(text))))
    new = F.when(F.size("spans") > 0, cut).otherwise(text)
    return found.select(*[(new if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
