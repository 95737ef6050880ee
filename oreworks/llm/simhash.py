"""Near copies by SimHash, with pigeonring filtering of the candidates.

A fingerprint has eight segments of eight bits on a ring. When two fingerprints differ in at most
three bits, some segment starts a chain in which the first ``l`` segments differ in at most
``3 * l / 8`` bits, for every ``l``. The first two segments of such a chain are equal, and of the
next three at least two are. So equal values of four segments bring candidates together; then the
whole chain is tested, and the Hamming distance is its last sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.shared import components, forest, in_blocks, key_runs, text_slices, whole_row
from oreworks.sinks.files import materialize

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 3
SEGMENTS = 8

#: Largest sum of differences over the first 1 to 8 segments of a chain.
BUDGETS = np.array([MAX_BITS * n // SEGMENTS for n in range(1, SEGMENTS + 1)])
#: For each start of a chain, which two of its third to fifth segments are equal.
EQUAL_PAIRS = ((2, 3), (2, 4), (3, 4))
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def fingerprint(text: bytes, width: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """SimHash of a text: a bit is set where over half the shingles' hashes have it.

    Words are separated by ASCII white space, A-Z count as a-z, repeated shingles count again. A
    text of fewer words is one shingle; one without words gives zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    last = ends[width - 1 :] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)),
        dtype=np.uint64,
        count=n,
    )
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65_000):
        part = hashes[at : at + 65_000].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    bits = np.packbits(2 * votes > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` for every row, the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                found = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, fp bigint"
    )


def _segment_keys() -> list:
    """Keys of four equal segments: the number of the chain and pair, and the 32 bits."""

    def segment(i: int):
        return F.shiftrightunsigned("fp", 8 * (i % SEGMENTS)).bitwiseAND(F.lit(255).cast("bigint"))

    keys = []
    for start in range(SEGMENTS):
        for a, b in EQUAL_PAIRS:
            bits = F.lit(len(keys)).cast("bigint")
            for i in (start, start + 1, start + a, start + b):
                bits = bits * F.lit(256) + segment(i)
            keys.append(bits)
    return keys


def _chained(differing: np.ndarray, start: int) -> np.ndarray:
    """Which rows of segment bytes that differ keep to the budgets along the chain from ``start``."""
    counts = _ONES[differing]
    ring = np.roll(counts, -start, axis=-1)
    return (np.cumsum(ring, axis=-1, dtype=np.uint8) <= BUDGETS).all(axis=-1)


def close_pairs(fps: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of pairs whose chain from ``start`` keeps to the budgets, so within three bits."""
    left, right = [], []
    step = max(1, 400_000 // max(1, len(fps)))
    for at in range(0, len(fps), step):
        differ = fps[at : at + step, None] ^ fps[None, :]
        i, j = np.nonzero(_chained(differ.view(np.uint8).reshape(*differ.shape, 8), start))
        keep = i + at < j
        left.append(i[keep] + at)
        right.append(j[keep])
    return np.concatenate(left), np.concatenate(right)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a: list[int] = []
    b: list[int] = []

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        a.clear()
        b.clear()
        return made

    for key, _, _, fps in key_runs(batches, 3):
        if len(fps) < 2:
            continue
        start = (int(key[0]) >> 32) // len(EQUAL_PAIRS)
        i, j = close_pairs(fps.astype("<i8"), start)
        for node, top in forest(fps[i], fps[j]).items():
            a.append(node)
            b.append(top)
        if len(a) > 50_000:
            yield out()
    yield out()


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints, as a forest for every group compared.

    No pair within three bits is lost from the components: it is compared in every bucket both
    are in, and a group of close fingerprints is connected there. Pairs are never written.
    """
    keyed = fps.select(F.explode(F.array(*_segment_keys())).alias("key"), "fp")
    dealt = in_blocks(keyed, ["key"], "fp").select("key", "low", "high", "fp")
    met = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "fp")
    return met.mapInArrow(_linked, "a bigint, b bigint")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp, component)`` per row: the smallest id among texts linked directly or through others.

    Texts whose fingerprints differ in at most three bits are linked; empty and null texts have
    fingerprint zero and are linked as any other. Rows with a null id belong to groups and connect
    them, and count last among the ids; a group without any id has a null component. Repeated rows
    stay. No row gives no row.
    """
    every = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialize(every.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-groups")
    found = components(fingerprint_links(distinct), "a", "b").withColumnRenamed("node", "fp")
    rooted = distinct.join(found, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component")
    return every.join(named, "fp").select("id", "fp", "component")


def hex_digits(column: str = "fp"):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near copies, that with the smallest id, with all its columns.

    Where the smallest id repeats, its first text in the order of the bytes stays. Rows without a
    near copy stay, and so do rows with a null id, which cannot be named as a copy.
    """
    names = docs.select(whole_row(docs), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kept = near_copies(docs, id_col, text_col).filter("id = component").groupBy("id")
    kept = kept.agg(F.count("*").alias("n"))
    found = names.join(kept, "id")
    again = found.filter("n > 1").groupBy("id")
    again = again.agg(F.min_by("row", F.struct(F.col("text").isNull(), "text")).alias("row"))
    parts = found.filter("n = 1").select("row"), again.select("row"), names.filter("id IS NULL").select("row")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("row.*")
