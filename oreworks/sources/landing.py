"""Reading landed files: JSON arrays, page files, single objects, JSON lines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.functions import ts_literal
from oreworks.schemas import BRONZE_SCHEMA

_EXACT = "decimal(38,6)"
# Page number in a file or folder name, as in page_7.json or page=7/part-0.json.
_PAGE = r"page[=_](\d+)"


def wide_longs(schema: T.StructType) -> T.StructType:
    """Longs are read as decimals: a fraction in the text must not turn the value into null."""
    fields = []
    for f in schema:
        is_long = isinstance(f.dataType, T.LongType)
        fields.append(T.StructField(f.name, T._parse_datatype_string(_EXACT)) if is_long else f)
    return T.StructType(fields)


def narrow_longs(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Back to the wanted schema; ``fraction_lost`` says whether a long had a fraction."""
    longs = [f.name for f in schema if isinstance(f.dataType, T.LongType)]
    lost = F.lit(False)
    for c in longs:
        lost = lost | F.coalesce(F.col(c) != F.floor(c), F.lit(False))
    kept = [c for c in df.columns if c not in schema.names]
    return df.select(
        *[
            F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in longs else F.col(f.name)
            for f in schema
        ],
        *kept,
        lost.alias("fraction_lost"),
    )


def read_json_arrays(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType = BRONZE_SCHEMA
) -> DataFrame:
    """Multi-line JSON array files, by path or glob, under a fixed schema.

    A file is one task here. Feeds with few large files should land JSON lines instead.
    """
    raw = spark.read.schema(wide_longs(schema)).option("multiLine", True).json(path)
    return narrow_longs(raw, schema)


def read_json_lines(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType = BRONZE_SCHEMA
) -> DataFrame:
    """One record per line: splittable, so one large file is read by many tasks."""
    return narrow_longs(spark.read.schema(wide_longs(schema)).json(path), schema)


def add_load_audit(df: DataFrame, loaded_at: datetime) -> DataFrame:
    """Load time and batch id."""
    stamp = ts_literal(loaded_at)
    return df.withColumns(
        {
            "bronze_loaded_at": stamp,
            "bronze_batch_id": F.lit(loaded_at.strftime("%Y%m%d%H%M%S")),
        }
    )


def read_page_texts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(extraction_page, file_name, text)``, one row per page file."""
    name = F.col("_metadata.file_path")
    return spark.read.text(path, wholetext=True).select(
        F.regexp_extract(name, _PAGE, 1).try_cast("int").alias("extraction_page"),
        name.alias("file_name"),
        F.col("value").alias("text"),
    )


def read_pages(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType = BRONZE_SCHEMA
) -> DataFrame:
    """All records of all readable pages. A page that is no complete JSON array gives no record.

    A page holds a fixed number of records, so a whole page is one row on its way in; parsing it
    at once is what makes a damaged page drop out as a whole, without a second read.
    """
    records = T.ArrayType(wide_longs(_without_tags(schema)))
    complete = read_page_texts(spark, path).filter(_complete_array("text"))
    pages = complete.withColumn("_r", F.from_json("text", records))
    return narrow_longs(pages.select("extraction_page", F.inline("_r")), _without_tags(schema))


def failed_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Pages that are no complete JSON array: cut ones, and error objects or scalars."""
    pages = read_page_texts(spark, path)
    return pages.filter(~_complete_array("text")).drop("text")


def _complete_array(text: str) -> Column:
    kind = F.schema_of_variant(F.try_parse_json(text))
    return F.coalesce(kind.startswith("ARRAY"), F.lit(False))


def _without_tags(schema: T.StructType) -> T.StructType:
    tags = ("extracted_at", "source", "extraction_page")
    return T.StructType([f for f in schema if f.name not in tags])


def tag_extraction(df: DataFrame, extracted_at: datetime, source: str) -> DataFrame:
    """Extraction time (ISO text) and source of every record; the page is set by the reader."""
    return df.withColumns(
        {"extracted_at": F.lit(extracted_at.isoformat()), "source": F.lit(source)}
    )


def read_objects(
    spark: SparkSession, path: str | Sequence[str], extracted_at: datetime, source: str
) -> DataFrame:
    """Single-object payloads, one per line, as semi-structured values with time and source."""
    raw = spark.read.option("singleVariantColumn", "payload").json(path)
    return tag_extraction(raw, extracted_at, source)


def explode_list(objects: DataFrame, payload: str, path: str, item: str = "item") -> DataFrame:
    """One row per element of a list inside the payload."""
    listed = F.try_variant_get(F.col(payload), path, "array<variant>")
    return objects.select("*", F.explode(listed).alias(item)).drop(payload)


def infer_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Records with inferred types, one record per line.

    Inference reads the data once more; give a schema where the layout is known.
    """
    return spark.read.json(path)


def select_paths(df: DataFrame, payload: str, paths: dict[str, tuple[str, str]]) -> list:
    """Typed columns out of a payload: ``{name: (json path, type)}``; a failed cast gives null."""
    return [
        F.try_variant_get(F.col(payload), p, t).alias(name) for name, (p, t) in paths.items()
    ]


def project_paths(
    df: DataFrame, payload: str, paths: dict[str, tuple[str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    return df.select(*keep, *select_paths(df, payload, paths))


def flatten_structs(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested objects become columns named by their path; lists stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()):
        for f in schema:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield here

    quoted = lambda parts: ".".join(f"`{p}`" for p in parts)
    return df.select(*[F.col(quoted(p)).alias(separator.join(p)) for p in leaves(df.schema)])


def select_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Records whose id occurs in ``ids``; an unknown id gives no row.

    A semi join of one pass: Spark broadcasts ids of a measured small size, and splits the
    partitions of a hot id otherwise.
    """
    return df.join(ids.select(key), key, "left_semi").select(*df.columns)


def register(df: DataFrame, name: str) -> DataFrame:
    """Publish a frame as a session view for the next step."""
    df.createOrReplaceTempView(name)
    return df
