"""Writing tables: modes, one-pass accepted/rejected split, partition replacement, clustering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.operators.ranges import range_limits, with_range_number
from oreworks.sinks.files import delete, exists, observed_counts, shared_dir, total_bytes

# An overwrite with this replaces only the partitions that occur in the written rows.
ONLY_OCCURRING = {"partitionOverwriteMode": "dynamic"}

# Z-order: cells a file, sampled rows a cell, characters of a text behind what all texts share, and
# how much of a shared beginning is looked at.
CELLS_PER_FILE = 8
SAMPLE_PER_CELL = 32
TEXT_HEAD = 64
MAX_SHARED_HEAD = 4096


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Append to or overwrite a table. An overwrite may change the schema.

    Rows of one partition value are brought together, but a large value is split over several
    tasks and small ones share a task (Spark's rebalance). ``counts`` are taken by the tasks that
    write, after the last shuffle, so a repeated task does not count twice.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    seen = Observation()
    if counts:
        df = df.observe(seen, *[e.alias(name) for name, e in counts.items()])
    df.write.mode(mode).options(**(options or {})).partitionBy(*partition_by).parquet(path)
    return observed_counts(seen, list(counts)) if counts else {}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All files of a table; columns added by later appends are null in earlier rows."""
    return spark.read.option("mergeSchema", True).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per line; null fields are kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_flagged(flagged: DataFrame, path: str, mode: str = "overwrite") -> dict[str, int]:
    """Write valid and invalid rows in one job, apart by ``is_valid``, and return both counts."""
    seen = Observation()
    valid = F.col("is_valid")
    counted = flagged.observe(
        seen, F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid")
    )
    counted.write.mode(mode).partitionBy("is_valid").parquet(path)
    return observed_counts(seen, ("valid", "invalid"))


def with_flag(df: DataFrame, flag: str) -> DataFrame:
    """A boolean partition column comes back as text; filters on the result still prune."""
    return df.withColumn(flag, F.col(flag) == "true")


def read_valid(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Valid rows of a flagged table. With its ``schema`` a table without any file can be read."""
    reader = spark.read
    if schema is not None:
        kinds = [T.StructField(f.name, T.StringType()) if f.name == "is_valid" else f for f in schema]
        reader = reader.schema(T.StructType(kinds))
    rows = with_flag(reader.parquet(path), "is_valid")
    return rows.filter("is_valid").drop("is_valid", "validation_errors")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return with_flag(spark.read.parquet(path), "is_valid").filter("NOT is_valid")


def quarantine(invalid: DataFrame, path: str, run_id: str) -> None:
    """Append rejected rows with their reasons under the run that rejected them."""
    target = f"{path}/run_id={run_id}"
    invalid.write.mode("overwrite").parquet(target)  # a repeated run replaces its own rows


def replace_partitions(df: DataFrame, path: str, partition_by: str, stage: str = "stage") -> int:
    """Replace the partitions that occur in ``df`` and leave the others alone.

    ``df`` may read the table itself: the rows are staged first, so that a failed write can be
    repeated from the stage and nothing is overwritten while it is read.
    """
    spark = df.sparkSession
    staged = shared_dir(spark, stage)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
    rows = observed_counts(seen, ("rows",))["rows"]
    if rows:
        staged_rows = spark.read.schema(df.schema).parquet(staged)
        write_table(staged_rows, path, "overwrite", [partition_by], options=ONLY_OCCURRING)
    return rows


def drop_partition(spark: SparkSession, path: str, partition_by: str, value: str) -> bool:
    """Remove one partition of a table; false when there was none."""
    target = f"{path}/{partition_by}={value}"
    return delete(spark, target) if exists(spark, target) else False


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType | T.BinaryType)


def _sortable_number(column: Column, kind: T.DataType) -> Column:
    """A number in the order of the values."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    return column.cast("double")


def _shared_head(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """How many characters or bytes all values of a column begin with.

    What the least and the greatest value share, all share. Two short heads a column come to the
    driver.
    """
    if not columns:
        return {}
    ends = [
        F.substring(end(c), 1, MAX_SHARED_HEAD).alias(f"{name}{place}")
        for place, c in enumerate(columns)
        for name, end in (("least", F.min), ("greatest", F.max))
    ]
    row = df.agg(*ends).first()
    heads = {}
    for place, c in enumerate(columns):
        pair = (row[f"least{place}"], row[f"greatest{place}"])
        heads[c] = 0 if None in pair else len(commonprefix([list(v) for v in pair]))
    return heads


def _sampled_limits(df: DataFrame, place: Column, values: dict[str, Column], bits: int) -> DataFrame:
    """One row with an array of limits per text column.

    The limits are the even steps of a sorted sample: the rows with the least hashes of their
    place, ``SAMPLE_PER_CELL`` a cell whatever the table's size. The sample only shapes the cells.
    """
    cells = 1 << bits
    sample = df.select(place.alias("_place"), *[v.alias(c) for c, v in values.items()])
    sample = sample.orderBy("_place").limit(SAMPLE_PER_CELL * cells)
    ordered = sample.agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in values])
    return ordered.select(F.struct(*[_even_steps(c, cells).alias(c) for c in values]).alias("l"))


def _even_steps(column: str, cells: int) -> Column:
    """The ``cells - 1`` inner limits of a sorted array."""
    at = lambda i: F.floor(i * F.size(column) / cells).cast("int")
    return F.transform(F.sequence(F.lit(1), F.lit(cells - 1)), lambda i: F.get(column, at(i)))


def with_z_key(
    df: DataFrame, columns: Sequence[str], bits: int = 6, place: str | None = None
) -> DataFrame:
    """Add the Morton key ``_z``: each column becomes a range number, and their bits interleave.

    Ranges follow the data, so skewed columns still use all cells: approximate quantiles of
    numbers and times from one aggregate, and steps of a sorted sample of the values themselves
    for text. Of text, what all values begin with is left out and the next ``TEXT_HEAD``
    characters count, which bounds the limits that travel with the plan. ``place`` names a column
    that is a hash of the row's place; without it the rows' values choose the sample.
    """
    if bits * len(columns) > 63:
        raise ValueError(f"{bits} bits of {len(columns)} columns don't fit into a key of 63 bits")
    kinds = {c: df.schema[c].dataType for c in columns}
    texts = [c for c in columns if _is_text(kinds[c])]
    heads = _shared_head(df, texts)
    values = {
        c: F.substring(F.col(c), heads[c] + 1, TEXT_HEAD)
        if c in heads
        else _sortable_number(F.col(c), kinds[c])
        for c in columns
    }
    numbers = {c: v for c, v in values.items() if c not in heads}
    limits = {}
    if numbers:
        quantiles = [range_limits(n, bits).alias(c) for c, n in numbers.items()]
        found = df.agg(F.struct(*quantiles).alias("l")).scalar()
        limits |= {c: found[c] for c in numbers}
    if texts:
        chosen = F.col(place) if place else F.xxhash64(*columns)
        found = _sampled_limits(df, chosen, {c: values[c] for c in texts}, bits).scalar()
        limits |= {c: found[c] for c in texts}
    keyed, key = df, F.lit(0).cast("bigint")
    for number, (c, value) in enumerate(values.items()):
        cell = f"_cell{number}"
        keyed = keyed.withColumn("_number", value)
        keyed = with_range_number(keyed, F.col("_number"), limits[c], bits, cell)
        for bit in range(bits):
            one = F.shiftright(F.col(cell).cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + number))
    cells = [f"_cell{number}" for number in range(len(columns))]
    return keyed.withColumn("_z", key).drop("_number", *cells)


def zorder_bits(files: int, columns: int) -> int:
    """Bits a column, so that all columns together have ``CELLS_PER_FILE`` cells a file at least.

    Between 4 and 12 bits: a column of 4,096 limits is the largest that travels with the plan.
    """
    wanted = max(files * CELLS_PER_FILE - 1, 1).bit_length()
    return min(max(-(-wanted // columns), 4), 12, 63 // columns)


def compact_zorder(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str] = ("coin_id", "updated_at"),
    bits: int | None = None,
    file_bytes: int = 128 << 20,
) -> None:
    """Rewrite a table into few files, rows near each other in all ``columns`` together.

    The range split goes by the key, the columns, and last the place of the row in its file, so
    that even many equal rows are divided over several files, the same way in a repeated task.
    The table's size in files of ``file_bytes`` sets the number of cells and, where it is more than
    the session's shuffle partitions, the number of files; a smaller table follows the session.
    """
    files = -(-total_bytes(spark, source) // file_bytes)
    rows = spark.read.parquet(source)
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_place")
    bits = bits or zorder_bits(files, len(columns))
    keyed = with_z_key(rows.select("*", place), columns, bits, "_place")
    order = ["_z", *columns]
    ranges = [F.col(c) for c in (*order, "_place")]
    few = files <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(*ranges) if few else keyed.repartitionByRange(files, *ranges)
    sorted_rows = ranged.sortWithinPartitions(*order).drop("_z", "_place")
    sorted_rows.write.mode("overwrite").parquet(target)
