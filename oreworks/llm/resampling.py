"""Importance resampling towards a target: hashed word n-grams, Gumbel top-k."""

from __future__ import annotations

import math
import operator
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from oreworks.llm.shared import text_slices
from oreworks.operators.ranking import value_positions
from oreworks.sinks.files import materialize

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of a text that are split into words at a time.
PIECE_BYTES = 1 << 20
#: Rows of a written file that are numbered together where scores and ids are equal.
CHUNK_ROWS = 1 << 16

#: A-Z become a-z; digits, letters and all bytes outside ASCII stay; all else is blank.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def _pieces(blanked: bytes, size: int) -> Iterator[bytes]:
    """Parts of a text that end at a blank, about ``size`` bytes each."""
    at = 0
    while at < len(blanked):
        end = blanked.find(b" ", at + size)
        end = len(blanked) if end < 0 else end
        yield blanked[at:end]
        at = end


def feature_hashes(text: bytes, longest: int = LONGEST, piece: int = PIECE_BYTES) -> Iterator[tuple[int, list[int]]]:
    """``(n, hashes)``: CRC-32 of the runs of ``n`` words, of one piece of the text after another.

    The hash of a run is the seed from which the hash of the run with one more word goes on, so no
    run is ever put together.
    """
    tail: list[bytes] = []
    for part in _pieces(text.translate(_TABLE), piece):
        words = tail + part.split()
        old = len(tail)
        spaced = [b" " + w for w in words]
        level = list(map(zlib.crc32, words))
        yield 1, level[old:]
        for n in range(2, longest + 1):
            level = list(map(zlib.crc32, spaced[n - 1 :], level))
            # Runs that lie in the tail as a whole were given with the piece before.
            yield n, level[max(0, old - n + 1) :]
        tail = words[-(longest - 1) :] if longest > 1 else []


def _counted(buckets: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                for text in texts:
                    for _, hashes in feature_hashes(text, longest):
                        counts.update(map(operator.mod, hashes, repeat(buckets)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["bucket", "n"]
        )

    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``(bucket, n)``: features of all texts per hash bucket. A task sends one row per bucket."""
    named = texts.select(F.col(text_col).cast("string").alias("text"))
    partial = named.mapInArrow(_counted(buckets, longest), "bucket int, n bigint")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Thousandths of the log ratio of smoothed frequencies, target over source, per bucket.

    The inputs are :func:`bucket_counts`, so at most ``buckets`` rows reach the driver from each.
    """
    s, t = ({r["bucket"]: r["n"] for r in counts.collect()} for counts in (source, target))
    s_all, t_all = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [
        math.floor(1000 * math.log(float(t.get(b, 0) + 1) * s_all / (float(s.get(b, 0) + 1) * t_all)))
        for b in range(buckets)
    ]


_WEIGHED = "n_words bigint, n_features bigint, weight bigint"


def _weighed(gains: list[int], longest: int):
    table = np.array(gains, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch.select(["text", "id", "kept"]), "text"):
                rows = []
                for text in texts:
                    words = features = weight = 0
                    for n, hashes in feature_hashes(text, longest):
                        at = np.fromiter(hashes, dtype=np.int64, count=len(hashes)) % len(table)
                        words += len(hashes) if n == 1 else 0
                        features += len(hashes)
                        weight += int(table[at].sum())
                    rows.append((words, features, weight))
                figures = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("kept"), *figures],
                    ["id", "kept", "n_words", "n_features", "weight"],
                )

    return run


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandths of a standard Gumbel value that a digest of seed and id decides; null is no text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    keep: Sequence[str] = (),
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Weight, score and rank of every document: ``id, kept, n_words, n_features, weight, score, rank``.

    Words are runs of digits, a-z (A-Z count as a-z) and bytes outside ASCII in UTF-8. Features are
    all runs of up to ``longest`` words. A document's weight is the sum of its features' gains, its
    score the weight plus a Gumbel value by its id, which makes the highest scores a draw without
    replacement in proportion to exp(weight). Of the documents with ``least_words`` or more,
    ``percent`` in a hundred (rounded down) have a rank: 1 for the highest score, ties to the
    smaller id, null ids last; the others have null.

    ``kept`` is a struct of the ``keep`` columns. Null and empty texts have no feature, weight 0 and
    no rank. Rows that repeat an id have one Gumbel value; of rows with equal id and score it is open
    which is first. An empty table gives no row, an empty target counts as smoothed zeros.

    Texts are read twice and not shuffled: the gains need the counts of the whole corpus. What
    reaches the driver is one number per bucket; scores are written once, and only rows at or above
    the score of the last one drawn are ranked, score by score.
    """
    source_counts = bucket_counts(docs, text_col, buckets, longest)
    gains = bucket_gains(source_counts, bucket_counts(target, target_text_col, buckets, longest), buckets)
    named = docs.select(
        F.col(text_col).cast("string").alias("text"),
        F.col(id_col).alias("id"),
        (F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in keep]) if keep else F.lit(None).cast("string")).alias("kept"),
    )
    kinds = T.StructType([named.schema["id"], named.schema["kept"], *T.StructType.fromDDL(_WEIGHED).fields])
    scored = named.mapInArrow(_weighed(gains, longest), kinds)
    scored = materialize(scored.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scores")

    able = scored.filter(F.col("n_words") >= least_words)
    wanted = able.count() * percent // 100
    columns = scored.columns
    none = F.lit(None).cast("bigint").alias("rank")
    if not wanted:
        return scored.select(*columns, none)
    starts = value_positions(able.select("score"), "score", descending=True)
    starts = materialize(starts.filter(F.col("start") < wanted).select("score", "start"), "score-starts")
    cut = starts.agg(F.min("score")).first()[0]
    drawable = (F.col("n_words") >= least_words) & (F.col("score") >= cut)
    # Equal scores and ids are numbered by the place of their rows in the written files, chunk by chunk.
    place = {"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")}
    first = scored.withColumns(place).filter(drawable).withColumn("_chunk", F.expr(f"_row DIV {CHUNK_ROWS}"))
    tie = ["score", "id", "_file", "_chunk"]
    in_score = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last(), "_file", "_chunk")
    before = F.sum("n").over(in_score.rowsBetween(Window.unboundedPreceding, -1))
    ties = first.groupBy(*tie).agg(F.count("*").alias("n")).join(starts, "score")
    ties = ties.withColumn("_at", F.col("start") + F.coalesce(before, F.lit(0))).select(
        *[F.col(c).alias(f"_t{c}") for c in tie], "_at"
    )
    match = F.col("id").eqNullSafe(F.col("_tid"))
    for c in ("score", "_file", "_chunk"):
        match = match & (F.col(c) == F.col(f"_t{c}"))
    nth = F.row_number().over(Window.partitionBy(*tie).orderBy("_row"))
    rank = (F.col("_at") + nth).cast("bigint")
    ranked = first.join(ties, match).withColumn("rank", F.when(rank <= wanted, rank))
    rest = scored.filter(~drawable).select(*columns, none)
    return ranked.select(*columns, "rank").unionByName(rest)


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn documents with their columns as they were, in no order."""
    found = resample(docs, target, keep=docs.columns, **settings)
    return found.filter("rank IS NOT NULL").select("kept.*")
