"""Large JSON array files read by many tasks, with the text of damaged records kept.

Spark's text reader splits a file at any separator of one's choice. Cut at every ``}``, a file
becomes pieces, and whether a piece ends a record follows from what stands before it: the quotes
(inside or outside of a string) and the braces (how deep). Both are running sums, taken inside a
block (one task's byte range) for either state at its start, and then over the blocks of a file,
one small row each. Records without inner objects are one piece and are parsed where they are;
only pieces of nested records are put together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from oreworks.schemas import BRONZE_SCHEMA
from oreworks.sinks.files import materialize
from oreworks.sources.landing import narrow_longs, wide_longs

_BLOCK = ("file_name", "block")
_CORRUPT = "corrupt_text"
# What stands between records: white space, commas and the brackets of the array, a BOM.
_BETWEEN = r"^[\s,\[\]\x{FEFF}]*"


def read_split_arrays(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType = BRONZE_SCHEMA
) -> DataFrame:
    """Records of JSON array files of any size, by path or glob, under a fixed schema.

    Adds ``fraction_lost`` as :func:`landing.narrow_longs`, ``file_name``, ``byte_offset`` (where
    the record's text begins to be looked for: after the end of the one before) and
    ``corrupt_text``: null for good records, else the text. A record with a value of a wrong type
    keeps what fits; one that is no JSON object has nulls only. Where quotes or braces don't add up,
    the rest of the file comes as corrupt rows, piece by piece, so no damaged file becomes one huge
    row. Empty files, empty arrays and blank ends give no row; a file of single objects one after
    the other is read like an array.
    """
    pieces = materialize(_pieces(spark, path), "json-pieces")
    placed = _placed(pieces, _block_starts(pieces))
    single = placed.filter("is_single").select(
        "file_name", "byte_offset", "text", F.lit(True).alias("is_whole")
    )
    parts = materialize(placed.filter("NOT is_single AND NOT is_blank"), "json-parts")
    texts = single.unionByName(_assembled(parts))
    return _parsed(texts, schema)


def _count(column: Column, what: str) -> Column:
    return F.regexp_count(column, F.lit(what))


def _pieces(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per piece with running sums inside its block.

    ``opens0`` and ``closes0`` hold if the block starts outside of a string, ``opens1`` and
    ``closes1`` if inside; the same goes for the depths before the piece.
    """
    read = spark.read.option("lineSep", "}").text(path)
    rows = read.select(
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    outside = F.regexp_replace(plain, r'"[^"]*("|$)', "")
    inside = F.regexp_replace(F.regexp_replace(plain, r'^[^"]*("|$)', ""), r'"[^"]*("|$)', "")
    quotes = _count(plain, '"')
    counted = rows.select(
        "*",
        (F.octet_length("value") + 1).cast("bigint").alias("bytes"),
        quotes.alias("quotes"),
        _count(outside, r"\{").alias("opens_out"),
        _count(inside, r"\{").alias("opens_in"),
    )
    before = Window.partitionBy(*_BLOCK).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    running = lambda c: F.coalesce(F.sum(c).over(before), zero)
    odd = (running("quotes") % 2).cast("int")
    known = counted.select("*", odd.alias("odd"), running("bytes").alias("bytes_before"))
    ends_odd = (F.col("odd") + F.col("quotes")) % 2
    for start in (0, 1):
        known = known.withColumns(
            {
                f"opens{start}": F.when(F.col("odd") == start, F.col("opens_out")).otherwise(
                    F.col("opens_in")
                ),
                f"closes{start}": (ends_odd == start).cast("int"),
            }
        )
    for start in (0, 1):
        change = F.col(f"opens{start}") - F.col(f"closes{start}")
        known = known.withColumn(f"depth{start}", running(change))
    return known.drop("opens_out", "opens_in", "seq")


def _block_starts(pieces: DataFrame) -> DataFrame:
    """``(file_name, block, in_string, depth, offset, ends_open)``, one row per block.

    A file has one row here per byte range of a task, so its rows are few however large it is.
    """
    change = lambda s: F.sum(F.col(f"opens{s}") - F.col(f"closes{s}"))
    blocks = pieces.groupBy(*_BLOCK).agg(
        F.sum("quotes").alias("quotes"),
        F.sum("bytes").alias("bytes"),
        change(0).alias("change0"),
        change(1).alias("change1"),
        F.max("file_size").alias("file_size"),
    )
    order = Window.partitionBy("file_name").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file_name")
    zero = F.lit(0).cast("bigint")
    running = lambda c: F.coalesce(F.sum(c).over(before), zero)
    with_state = blocks.select(
        "*",
        (running("quotes") % 2 == 1).alias("in_string"),
        running("bytes").alias("offset"),
    )
    change = F.when(F.col("in_string"), F.col("change1")).otherwise(F.col("change0"))
    deep = with_state.withColumn("change", change).withColumn("depth", running("change"))
    # The last piece has no brace at its end if the pieces with one each are longer than the file.
    unclosed = F.sum("bytes").over(whole) > F.col("file_size")
    odd_end = F.sum("quotes").over(whole) % 2 == 1
    counted_close = (unclosed & ~odd_end).cast("int")
    left_open = odd_end | (F.sum("change").over(whole) + counted_close > 0)
    return deep.select(*_BLOCK, "in_string", "depth", "offset", left_open.alias("left_open"))


def _placed(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Pieces with their place in the file and what they are there."""
    starts = starts.withColumnsRenamed({"file_name": "_file", "block": "_block"})
    same = (F.col("file_name") == F.col("_file")) & (F.col("block") == F.col("_block"))
    rows = pieces.join(starts, same)
    pick = lambda name: F.when(F.col("in_string"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    at = F.col("offset") + F.col("bytes_before")
    has_end = at + F.col("bytes") <= F.col("file_size")
    state = rows.select(
        *_BLOCK,
        "value",
        "left_open",
        at.alias("byte_offset"),
        has_end.alias("has_end"),
        (F.col("depth") + pick("depth")).alias("before"),
        pick("opens").alias("opens"),
        F.when(has_end, pick("closes")).otherwise(0).alias("closes"),
        ((F.col("odd") == 1) != F.col("in_string")).alias("starts_inside"),
    )
    is_head = ~F.col("starts_inside") & (F.col("before") <= 0)
    one = is_head & F.col("has_end") & (F.col("opens") == 1) & (F.col("closes") == 1)
    blank = is_head & ~F.col("has_end") & (F.regexp_replace("value", _BETWEEN, "") == "")
    end = F.when(F.col("has_end"), F.lit("}")).otherwise(F.lit(""))
    return state.select(
        *_BLOCK,
        "byte_offset",
        "left_open",
        F.concat("value", end).alias("text"),
        is_head.alias("is_head"),
        one.alias("is_single"),
        blank.alias("is_blank"),
    )


def _assembled(parts: DataFrame) -> DataFrame:
    """Records of several pieces put together; an unfinished end of a file stays in pieces."""
    head = F.when(F.col("is_head"), F.col("byte_offset"))
    blocks = parts.groupBy(*_BLOCK).agg(F.max(head).alias("last"))
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy("file_name")
    carried = blocks.select(
        F.col("file_name").alias("_file"),
        F.col("block").alias("_block"),
        F.max("last").over(earlier).alias("carried"),
        F.max("last").over(whole).alias("final"),
    )
    so_far = Window.partitionBy(*_BLOCK).orderBy("byte_offset").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    known = parts.withColumn("here", F.max(head).over(so_far))
    same = (F.col("file_name") == F.col("_file")) & (F.col("block") == F.col("_block"))
    known = known.join(carried, same).withColumn("head", F.coalesce("here", "carried"))
    nowhere = F.lit(-1)
    at_end = F.coalesce("head", nowhere) == F.coalesce("final", nowhere)
    unfinished = F.col("left_open") & at_end
    # Pieces of an unfinished end are groups of their own.
    group = F.when(unfinished, F.col("byte_offset")).otherwise(F.col("head"))
    listed = F.sort_array(F.collect_list(F.struct("byte_offset", "text")))
    joined = known.groupBy("file_name", group.alias("group")).agg(
        listed.alias("pieces"), F.bool_and(~unfinished).alias("is_whole")
    )
    return joined.select(
        "file_name",
        F.col("group").alias("byte_offset"),
        F.array_join(F.col("pieces.text"), "").alias("text"),
        "is_whole",
    )


def _parsed(texts: DataFrame, schema: T.StructType) -> DataFrame:
    wide = T.StructType([*wide_longs(schema), T.StructField(_CORRUPT, T.StringType())])
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    clean = texts.withColumn("text", F.regexp_replace("text", _BETWEEN, "")).filter("text <> ''")
    parsed = clean.withColumn("_r", F.from_json("text", wide, options))
    corrupt = F.when(F.col("is_whole"), F.col(f"_r.{_CORRUPT}")).otherwise(F.col("text"))
    fields = [F.col("_r")[f.name].alias(f.name) for f in schema]
    rows = parsed.select("file_name", "byte_offset", *fields, corrupt.alias(_CORRUPT))
    return narrow_longs(rows, schema)
