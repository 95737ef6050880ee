"""What several operators need: batches as numpy arrays, forests inside a task, components of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.sinks.files import materialize

#: Rows of a bucket that meet in one task; a larger bucket is compared block by block.
BLOCK_ROWS = 2048
#: Bytes of text that a task has as Python objects at a time.
SLICE_BYTES = 2 << 20


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts of a batch in UTF-8; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with about ``limit`` bytes of text each, and their texts in UTF-8.

    ``column`` is a column of the batch, or else of its ``row``.

    A longer text is a part of its own. A batch may hold thousands of texts; only those of one part
    are Python objects at a time.
    """
    own = batch.column(column) if "row" not in batch.schema.names else batch.column("row").field(column)
    sizes = pc.fill_null(pc.binary_length(own), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield batch.slice(start, i - start), as_bytes(own.slice(start, i - start))
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start), as_bytes(own.slice(start))


def key_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of each run of rows with equal keys (the first ``keys`` columns) in sorted batches."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        new = np.zeros(len(columns[0]), dtype=bool)
        for c in columns[:keys]:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            yield [c[a:b] for c in columns]
        held = [c[starts[-1] :] for c in columns]
    if held is not None:
        yield held


def forest(left: np.ndarray, right: np.ndarray) -> dict[int, int]:
    """Links as a forest: each node that is not the smallest of its tree, with that smallest node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        path = []
        while (up := parent.get(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            parent[p] = x
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def in_blocks(rows: DataFrame, keys: list[str], member: str, size: int = BLOCK_ROWS) -> DataFrame:
    """Rows of buckets with two rows or more, dealt to the pairs of blocks of their bucket.

    Adds ``low``, ``high`` and ``block``. A bucket of ``n`` rows has about ``n / size`` blocks, and
    every pair of blocks is a group of its own, so that each pair of rows meets in at least one
    group of about ``2 * size`` rows, however large the bucket is. Lone rows go.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(size)).cast("int")
    dealt = (
        rows.join(counts, keys)
        .withColumn("_blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
    )
    return (
        dealt.withColumn("low", F.least("block", "_other"))
        .withColumn("high", F.greatest("block", "_other"))
        .drop("_n", "_blocks", "_other")
    )


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = forest(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        nodes = np.fromiter(links.keys(), dtype=np.int64, count=len(links))
        roots = np.fromiter(links.values(), dtype=np.int64, count=len(links))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["u", "v"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` for every node with a link; the component is its smallest node.

    Links may be in any order and repeat. Each round hangs the larger neighbours of a node, then
    the smaller ones, onto its smallest neighbour, until nothing changes; tasks contract what they
    hold first. Minima combine before the shuffle and joins by node are plain equi joins, so a node
    with very many links does not gather in one task. Each round is a written table.
    """
    edges = links.select(F.col(left).cast("bigint").alias("u"), F.col(right).cast("bigint").alias("v"))
    edges = edges.filter("u <> v").mapInArrow(_contract, "u bigint, v bigint").distinct()
    edges = materialize(edges, "links")
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        wide = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        wide = materialize(wide.distinct(), "links")
        least = wide.groupBy("u").agg(F.min("v").alias("m"))
        near = wide.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        near = near.unionByName(least.withColumnRenamed("m", "v"))
        edges = materialize(near.distinct(), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, out of the way of names that an operator adds."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias("row")


def row_schema(df: DataFrame, more: str) -> T.StructType:
    """``row`` with the columns of a frame, and further columns in DDL. Names may be any."""
    own = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    return T.StructType([T.StructField("row", own), *T.StructType.fromDDL(more).fields])


def with_text(rows: DataFrame, docs: DataFrame, text_col: str, length_col: str) -> DataFrame:
    """The columns of ``docs`` out of ``row``, with a new ``text``; the length is set where it changed."""
    columns = []
    old_text = F.col("row")[text_col]
    changed = ~F.col("text").eqNullSafe(old_text)
    for f in docs.schema:
        value = F.col("row")[f.name]
        if f.name == text_col:
            value = F.col("text")
        elif f.name == length_col:
            value = F.when(changed, F.char_length("text").cast(f.dataType)).otherwise(value)
        columns.append(value.alias(f.name))
    return rows.select(*columns)


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
