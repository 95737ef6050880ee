"""Benchmark decontamination: an FM-index over the words of each training shard.

A shard is a run of documents within a task. Its words become numbers, all words that no test
phrase has sharing one. The index answers all phrases by backward search over wavelet-tree ranks;
places come from sampled suffix positions; the spans found in a document are merged.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.shared import row_schema, text_slices, whole_row, with_text

PHRASE_WORDS = 10
#: Words of documents per index, and every how many positions a suffix is sampled.
SHARD_WORDS = 500_000
SAMPLE_STEP = 16
#: Bytes of benchmark texts sent to the tasks at once; more are searched in several passes.
BLOCK_BYTES = 16 << 20

#: Bytes that are no part of a word become blanks, A-Z become a-z. Every byte of a character
#: beyond ASCII is part of a word, so offsets in bytes stay those of the text.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def word_offsets(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end byte of each word."""
    inside = np.frombuffer(text.translate(_WORD_BYTES), dtype=np.uint8) != 0x20
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector per level, zeros before ones on the next."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.levels: list[tuple[int, np.ndarray, int]] = []
        now = symbols
        for level in reversed(range(max(1, int(sigma - 1).bit_length()))):
            ones = (now >> level) & 1
            before = np.concatenate(([0], np.cumsum(ones, dtype=np.int32)))
            zeros = len(now) - int(before[-1])
            self.levels.append((level, before, zeros))
            now = np.concatenate((now[ones == 0], now[ones == 1]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        low, high = np.zeros_like(ends), ends
        for level, before, zeros in self.levels:
            one = ((symbols >> level) & 1).astype(bool)
            low = np.where(one, zeros + before[low], low - before[low])
            high = np.where(one, zeros + before[high], high - before[high])
        return high - low


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling. Zeros separate runs and count as distinct, in text order."""
    n = len(text)
    gaps = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(gaps)
    rank[gaps] = np.arange(len(gaps))
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        ranked = rank[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        following = np.zeros(n, dtype=np.int64)
        following[: n - width] = rank[width:] + 1
        rank = rank * (n + 1) + following
        order = np.argsort(rank, kind="stable")
        width *= 2


class FMIndex:
    """Backward search and location over a text of positive symbols in runs ended by zeros."""

    def __init__(self, text: np.ndarray, sigma: int, step: int = SAMPLE_STEP) -> None:
        order = suffix_order(text)
        self.last = text[order - 1]  # the symbol before each suffix; before the first is a zero
        self.tree = WaveletTree(self.last, sigma)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        # Positions are sampled at every step and at the start of each run, where a walk must end.
        sampled = (order % step == 0) | (self.last == 0)
        self.sampled = sampled
        self.before = np.concatenate(([0], np.cumsum(sampled, dtype=np.int32)))
        self.positions = order[sampled]
        self.size = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each phrase (rows of equal length)."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        alive = np.arange(len(phrases))
        for at in reversed(range(phrases.shape[1])):
            symbols = phrases[alive, at]
            low[alive] = self.first[symbols] + self.tree.rank(symbols, low[alive])
            high[alive] = self.first[symbols] + self.tree.rank(symbols, high[alive])
            gone = alive[low[alive] >= high[alive]]
            high[gone] = low[gone]
            alive = alive[low[alive] < high[alive]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: step back until a sampled one."""
        found = np.zeros(len(rows), dtype=np.int64)
        steps = np.zeros(len(rows), dtype=np.int64)
        rows = rows.copy()
        going = np.arange(len(rows))
        while len(going):
            at = rows[going]
            done = self.sampled[at]
            found[going[done]] = self.positions[self.before[at[done]]] + steps[going[done]]
            going, at = going[~done], at[~done]
            symbols = self.last[at]
            rows[going] = self.first[symbols] + self.tree.rank(symbols, at)
            steps[going] += 1
        return found


@dataclass
class Phrases:
    """Windows of test items as numbers, by length, with the items that hold each window."""

    numbers: dict[bytes, int] = field(default_factory=dict)
    windows: dict[int, np.ndarray] = field(default_factory=dict)
    items: dict[int, list[list[str]]] = field(default_factory=dict)

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], size: int = PHRASE_WORDS) -> Phrases:
        own = cls()
        found: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for name, text in items:
            words = [own.numbers.setdefault(w, len(own.numbers) + 1) for w in words_of(text)]
            width = min(size, len(words))
            for i in range(len(words) - width + 1 if width else 0):
                found[width][tuple(words[i : i + width])].add(name)
        for width, windows in found.items():
            own.windows[width] = np.array(list(windows), dtype=np.int64)
            own.items[width] = [sorted(x) for x in windows.values()]
        return own


def _live_runs(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The text to index and the place of each symbol.

    Words that no phrase has separate the others; a run shorter than every phrase holds none.
    """
    edges = np.diff(np.concatenate(([0], (ids > 0).view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    lengths = ends - starts + 1  # with one zero after each run
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    places = np.arange(lengths.sum()) + np.repeat(starts - first, lengths)
    text = np.append(ids, 0)[places]
    text[first + lengths - 1] = 0
    return text, places


def find_in_shard(docs: list[list[bytes]], phrases: Phrases) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
    """Merged word spans of phrase occurrences in each document, and the items they come from.

    Documents are lists of words; phrases don't reach over the end of a document.
    """
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    items: list[set[str]] = [set() for _ in docs]
    lengths = np.array([len(d) + 1 for d in docs])
    first = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(docs) else lengths
    number = phrases.numbers.get
    ids = np.fromiter(
        (x for d in docs for x in (*(number(w, 0) for w in d), 0)), dtype=np.int64, count=int(lengths.sum())
    )
    if not phrases.windows:
        return spans, items
    text, places = _live_runs(ids, min(phrases.windows))
    if not len(text):
        return spans, items
    index = FMIndex(text, len(phrases.numbers) + 1)
    cover = np.zeros(len(ids) + 1, dtype=np.int64)
    for width, windows in phrases.windows.items():
        low, high = index.search(windows)
        hits = np.flatnonzero(high > low)
        counts = high[hits] - low[hits]
        which = np.repeat(hits, counts)
        rows = np.arange(counts.sum()) + np.repeat(low[hits] - np.cumsum(counts) + counts, counts)
        at = places[index.locate(rows)]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + width, -1)
        where = np.searchsorted(first, at, side="right") - 1
        for pair in np.unique(np.stack((where, which), axis=1), axis=0).tolist():
            items[pair[0]].update(phrases.items[width][pair[1]])
    edges = np.diff(np.concatenate(([0], (np.cumsum(cover) > 0).view(np.int8))))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    for i, a, b in zip((np.searchsorted(first, starts, side="right") - 1).tolist(), starts.tolist(), ends.tolist(), strict=True):
        spans[i].append((a - int(first[i]), b - int(first[i])))
    return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark in parts of about ``block_bytes``, by a hash of the item."""
    size = F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)))
    total = benchmark.agg(size).first()[0] or 0
    n = math.ceil(total / block_bytes) or 1
    part = F.pmod(F.xxhash64(id_col, text_col), F.lit(n))
    return [benchmark.filter(part == i).select(F.col(id_col).cast("string"), text_col) for i in range(n)]


_FOUND = "n_words: bigint, spans: array<struct<start:int,end:int>>, items: array<string>"


def _searched(phrases, text_col: str, shard_words: int):
    """Add what one block of phrases finds to what earlier blocks found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words: list[int] = []
            spans: list[list[tuple[int, int]]] = []
            items: list[set[str]] = []
            shard: list[list[bytes]] = []
            held = 0

            def search() -> None:
                found, named = find_in_shard(shard, phrases.value)  # noqa: B023
                spans.extend(found)  # noqa: B023
                items.extend(named)  # noqa: B023
                shard.clear()  # noqa: B023

            for _, texts in text_slices(batch, text_col):
                for text in texts:
                    words = words_of(text)
                    n_words.append(len(words))
                    if held and held + len(words) > shard_words:
                        search()
                        held = 0
                    shard.append(words)
                    held += len(words)
            search()
            if "found" in batch.schema.names:
                earlier = batch.column("found").to_pylist()
                spans = [merged([(s["start"], s["end"]) for s in e["spans"]] + s) for e, s in zip(earlier, spans, strict=True)]
                items = [set(e["items"]) | i for e, i in zip(earlier, items, strict=True)]
            found = pa.StructArray.from_arrays(
                [
                    pa.array(n_words, pa.int64()),
                    pa.array(
                        [[{"start": a, "end": b} for a, b in s] for s in spans],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                    ),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                ],
                ["n_words", "spans", "items"],
            )
            yield pa.RecordBatch.from_arrays([batch.column("row"), found], ["row", "found"])

    return run


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    size: int = PHRASE_WORDS,
    shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row`` (the input's columns) and ``found`` for every document.

    ``found`` has the number of words, the merged spans of words (start, end) inside any occurrence
    of a window of ``size`` consecutive benchmark words, and the items with such windows, sorted as
    strings. An item of fewer words is one window. Windows count wherever they occur, also across
    lines, but not across documents; repeated items and windows count once; an item without an id
    is listed as an empty string. Null and empty texts have no words. No shuffle: phrases go to the
    tasks in blocks of bounded size, one pass over a task's rows for each.
    """
    spark = docs.sparkSession
    out = docs.select(whole_row(docs))
    for block in _blocks(benchmark, item_col, item_text, block_bytes):
        known = [(name or "", (text or "").encode()) for name, text in block.toLocalIterator()]
        phrases = spark.sparkContext.broadcast(Phrases.of(known, size))
        out = out.mapInArrow(
            _searched(phrases, text_col, shard_words), row_schema(docs, f"found struct<{_FOUND}>")
        )
    return out


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    if not spans:
        return text
    starts, ends = word_offsets(text)
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at : starts[a]])
        at = ends[b - 1]
    return b"".join([*parts, text[at:]])


def _cut(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, given in text_slices(batch, text_col):
                spans = [[(s["start"], s["end"]) for s in f["spans"]] for f in part.column("found").to_pylist()]
                texts = [without_spans(t, s).decode() for t, s in zip(given, spans, strict=True)]
                null = part.column("row").field(text_col).is_null().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string(), mask=null)], ["row", "text"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with the spans found cut out of their texts and their lengths set anew.

    Documents without a span stay as they are, and none goes. Columns and their order stay.
    """
    cut = find_benchmark(docs, benchmark, text_col).mapInArrow(_cut(text_col), row_schema(docs, "text string"))
    return with_text(cut, docs, text_col, length_col)
