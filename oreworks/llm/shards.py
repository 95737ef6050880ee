"""Two-pass external shuffle of records into shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreworks.llm.shared import row_schema, whole_row
from oreworks.sinks.files import materialize, shared_dir

SHARDS = 24
SEED = 20_240
#: Bytes of records aimed at per bucket, which one task shuffles in memory.
BUCKET_BYTES = 32 << 20
#: The first place of each bucket (two numbers) is broadcast up to so many buckets, else joined.
BROADCAST_BUCKETS = 1_000_000


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation: from the end, each place swaps with one at or before it."""
    order = np.arange(n)
    other = rng.integers(0, np.arange(n, 0, -1)) if n else order
    for i, j in zip(range(n - 1, 0, -1), other.tolist(), strict=False):
        order[i], order[j] = order[j], order[i]
    return order


def _shuffled(seed: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        # The order in which a shuffle delivers rows changes from run to run; their hashes don't.
        given = np.argsort(table.column("hash").to_numpy(), kind="stable")
        order = fisher_yates(table.num_rows, np.random.default_rng([seed, bucket]))
        return table.take(pa.array(given[order])).append_column(
            "place", pa.array(np.arange(table.num_rows, dtype=np.int64))
        )

    return run


def _place(rows: DataFrame) -> Column:
    """The place of a row in its Parquet file, also where a column has the name of the metadata."""
    own = rows.metadataColumn("_metadata")
    return F.xxhash64(own["file_path"], own["row_index"])


def _with_place(rows: DataFrame) -> DataFrame:
    """Rows straight from Parquet files, whose places a repeated task finds again."""
    try:
        rows.select(_place(rows))
    except AnalysisException:
        return materialize(rows, "unshuffled")
    return rows


def _hot_repeats(sizes: DataFrame, bucket_bytes: int) -> DataFrame:
    """Hashes of repeated rows that hold more than half a bucket; at most two a bucket."""
    per_hash = sizes.groupBy("hash").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    hot = per_hash.filter((F.col("n") > 1) & (F.col("bytes") > F.lit(bucket_bytes // 2)))
    return materialize(hot.select(F.col("hash").alias("hot")), "hot-repeats")


def _small(table: DataFrame, buckets: int) -> DataFrame:
    """A table of at most two rows a bucket, broadcast up to so many buckets."""
    return F.broadcast(table) if buckets <= BROADCAST_BUCKETS else table


def shuffle_into_shards(
    rows: DataFrame,
    id_col: str,
    text_col: str,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> DataFrame:
    """Shuffle records and deal them to shards whose row counts differ by at most one.

    Pass one scatters the records by a seeded hash of id and text into as many buckets as their
    bytes need. Pass two shuffles each bucket in one task (Fisher-Yates, seeded by the bucket) and
    writes it. Buckets follow one another; a shard is a range of that order. Copies of a text have
    ids of their own and spread over all buckets. Rows that repeat id and text so often that they
    fill half a bucket are scattered by their places in the files instead.

    The written table has the input's columns in ``row``, and ``bucket`` and ``place``. Returns it
    with ``size`` (UTF-8 bytes of the text plus 8), ``shard`` and ``slot`` added. The same rows and
    seed give the same shards, however the input is partitioned; of rows with equal id and text it
    is open which is where. Null ids and texts are values like any other; no row gives no row.
    """
    text = F.col(text_col).cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("bigint").alias("size")
    key = F.xxhash64(F.lit(seed), F.col(id_col), text).alias("hash")
    schema = row_schema(rows, "size bigint, hash bigint, bucket bigint, place bigint")
    total = rows.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    hot = _hot_repeats(rows.select(size, key), bucket_bytes)
    scattered = not hot.isEmpty()
    if scattered:
        rows = _with_place(rows)
    place = _place(rows) if scattered else F.lit(None).cast("bigint")
    named = rows.select(whole_row(rows).cast(schema["row"].dataType).alias("row"), size, key, place.alias("at"))
    if scattered:
        named = named.join(_small(hot, buckets), F.col("hash") == F.col("hot"), "left")
        own = F.when(F.col("hot").isNotNull(), F.xxhash64("hash", "at")).otherwise(F.col("hash"))
        named = named.withColumn("hash", own)
    named = named.select("row", "size", "hash")
    named = named.withColumn("bucket", F.pmod(F.col("hash"), F.lit(buckets)))
    dealt = named.repartition(buckets, "bucket").groupBy("bucket")
    path = path or shared_dir(rows.sparkSession, "shuffled")
    dealt.applyInArrow(_shuffled(seed), schema).drop("hash").write.parquet(path)
    written = rows.sparkSession.read.parquet(path)
    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))
    # One row per bucket: a count that is bounded by the bytes over the size of a bucket.
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialize(counts.select("bucket", "n", F.coalesce(before, F.lit(0)).alias("start")), "starts")
    n_rows = starts.agg(F.sum("n")).first()[0] or 0
    least, longer = divmod(n_rows, shards)
    edge = longer * (least + 1)
    at = F.col("start") + F.col("place")
    in_long = at < F.lit(edge)
    later = at - F.lit(edge)
    short = F.lit(max(1, least))
    shard = F.when(in_long, F.expr(f"(start + place) DIV {least + 1}")).otherwise(
        F.lit(longer) + F.floor(later / short)
    )
    slot = F.when(in_long, at % F.lit(least + 1)).otherwise(later % short)
    starts = _small(starts.select(F.col("bucket").alias("_b"), "start"), buckets)
    placed = written.join(starts, F.col("bucket") == F.col("_b"))
    return placed.select(
        "row", "size", "bucket", "place", shard.cast("int").alias("shard"), slot.cast("bigint").alias("slot")
    )


def batches_of(shuffled: DataFrame, shard: int) -> Iterator:
    """Rows of one shard in the order of their slots, for a reader that trains on them."""
    return shuffled.filter(F.col("shard") == shard).orderBy("slot").select("row.*").toLocalIterator()
