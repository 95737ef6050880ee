"""How the sources of a language differ in their terms.

Tasks count terms with Arrow's own kernels and send partial counts; merged counts are cut into
columnar shards of terms, each a small matrix of sources and terms, whose divergences add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreworks.sinks.files import materialize

LEAST_DOCS = 10
TOP_TERMS = 10
#: Bytes of text that are split into terms at a time, and rows of counts in a shard of terms.
SLICE_BYTES = 2 << 20
SHARD_ROWS = 100_000
#: Numbers of a matrix of sources and terms that a task has at a time.
MATRIX_CELLS = 1 << 20
# The unit of a share and what is added to each count.
UNIT, ADDED = 1_000_000_000, 2
_SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def _slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text; a longer text is one of its own."""
    sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        reached = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, reached + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def term_counts(part: pa.RecordBatch) -> pa.RecordBatch:
    """``lang, source, term, n, docs`` of some documents: occurrences, and documents that have the term.

    Each pair of a language and source also has a row with an empty term, which is no term.
    """
    pieces = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), pattern=_SEPARATORS)
    doc, terms = pc.list_parent_indices(pieces), pc.list_flatten(pieces)
    full = pc.not_equal(pc.binary_length(terms), 0)
    encoded = pc.dictionary_encode(terms.filter(full))
    tokens = pa.table({"doc": doc.filter(full), "term": encoded.indices})
    in_doc = tokens.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    lang, source = pc.dictionary_encode(part.column("lang")), pc.dictionary_encode(part.column("source"))
    at = in_doc.column("doc")
    grouped = pa.table(
        {
            "lang": pc.take(lang.indices, at),
            "source": pc.take(source.indices, at),
            "term": in_doc.column("term"),
            "n": in_doc.column("count_all"),
        }
    )
    found = grouped.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    pairs = pa.table({"lang": lang.indices, "source": source.indices}).group_by(["lang", "source"], use_threads=False)
    pairs = pairs.aggregate([])
    none = pa.array(np.zeros(pairs.num_rows, dtype=np.int64))
    columns = [
        pa.concat_arrays([_taken(d, t.column(name)) for t in (found, pairs)])
        for d, name in ((lang.dictionary, "lang"), (source.dictionary, "source"))
    ]
    columns.append(pa.concat_arrays([_taken(encoded.dictionary, found.column("term")), pa.array([""] * pairs.num_rows, pa.string())]))
    for name in ("n_sum", "count_all"):
        columns.append(pa.concat_arrays([found.column(name).combine_chunks().cast(pa.int64()), none]))
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def _taken(values: pa.Array, at: pa.ChunkedArray) -> pa.Array:
    return values.take(at.combine_chunks()).cast(pa.string())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch, SLICE_BYTES):
            yield term_counts(part)


def _share(count: str, total: str, terms: str) -> Column:
    """Smoothed share of a term, exact for counts of any size."""
    return F.expr(
        f"1 + (CAST({UNIT} AS DECIMAL(38,0)) * ({count} + {ADDED})) DIV CAST({total} + {ADDED} * {terms} AS DECIMAL(38,0))"
    )


def pair_sums(p: np.ndarray) -> np.ndarray:
    """Sums of floor((p - q)² / (p + q)) over the columns, for each pair of rows, the first smaller."""
    sums = np.zeros((len(p), len(p)), dtype=np.int64)
    step = max(1, MATRIX_CELLS // max(1, len(p)))
    for at in range(0, p.shape[1], step):
        part = p[:, at : at + step]
        for i in range(len(p) - 1):
            apart = part[i] - part[i + 1 :]
            sums[i, i + 1 :] += (apart * apart // (part[i] + part[i + 1 :])).sum(axis=1)
    return sums


def _shard_sums(shard: pa.Table) -> pa.Table:
    """Partial sums of all pairs of sources over the terms of one shard."""
    lang = shard.column("lang")[0].as_py()
    # The row of a source without a term has its share of terms that it doesn't have.
    empty = pc.equal(shard.column("term"), "")
    sources = shard.filter(empty).sort_by("source")
    names = sources.column("source").combine_chunks()
    rest = shard.filter(pc.invert(empty))
    row = pc.index_in(rest.column("source"), value_set=names).to_numpy()
    terms = rest.column("term").combine_chunks().dictionary_encode()
    place = terms.indices.to_numpy()
    base = sources.column("p").to_numpy()
    sums = np.zeros((len(names), len(names)), dtype=np.int64)
    step = max(1, MATRIX_CELLS // max(1, len(names)))
    order = np.argsort(place, kind="stable")
    row, place, p = row[order], place[order], rest.column("p").to_numpy()[order]
    for at in range(0, len(terms.dictionary), step):
        a, b = np.searchsorted(place, (at, at + step))
        width = min(step, len(terms.dictionary) - at)
        matrix = np.repeat(base[:, None], width, axis=1)
        matrix[row[a:b], place[a:b] - at] = p[a:b]
        sums += pair_sums(matrix)
    first, second = np.triu_indices(len(names), 1)
    columns = [pa.array([lang] * len(first), pa.string()), names.take(pa.array(first)), names.take(pa.array(second))]
    return pa.Table.from_arrays([*columns, pa.array(sums[first, second])], ["lang", "source", "item", "value"])


def source_divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from the others of its language.

    Terms are runs of a-z (A-Z count as a-z) and of characters outside ASCII. A language keeps the
    terms that ``least_docs`` of its documents have. Every source has a smoothed share of each kept
    term, and so has the language. Part ``pair`` has every other source with the sum of
    floor((p - q)² / (p + q)) over all kept terms; part ``term`` the ``top`` terms that are more
    frequent in the source than in the language, by the same figure. Ranks go by falling value, then
    by the item in UTF-8.

    Null text, language and source are empty text. Rows that repeat count as often as they occur. A
    source without terms is compared like any other; one alone in its language has no pair. An
    empty table gives no row.

    Texts are not shuffled: slices of documents send one row per term that they have, which Spark
    adds up before and after the shuffle. Pairs are computed shard by shard of terms, so no source or
    term is one task.
    """
    filled = [
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
        for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    ]
    counts = docs.select(*filled).mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term")
    counts = materialize(counts.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")

    of_term = Window.partitionBy("lang", "term")
    kept = counts.filter("term <> ''").withColumns(
        {
            "in_docs": F.sum("docs").over(of_term),
            "in_lang": F.sum("n").over(of_term),
            "first": F.min("source").over(of_term) == F.col("source"),
        }
    )
    kept = materialize(kept.filter(F.col("in_docs") >= least_docs).drop("docs", "in_docs"), "kept-terms")
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if("first").alias("terms"))
    by_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
    groups = counts.filter("term = ''").select("lang", "source").join(by_source, ["lang", "source"], "left")
    groups = groups.join(by_lang, "lang", "left").na.fill(0, ["source_n", "lang_n", "terms"])
    groups = materialize(groups, "source-sizes")

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share("n", "source_n", "terms"))
    over = shares.withColumn("q", _share("in_lang", "lang_n", "terms")).filter("p > q")
    over = over.withColumn("value", F.expr("((p - q) * (p - q)) DIV (p + q)"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    tops = over.select("lang", "source", F.col("term").alias("item"), "value")
    tops = tops.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)

    shards = max(1, -(-kept.count() // SHARD_ROWS))
    absent = F.when(F.col("terms") > 0, _share("0", "source_n", "terms")).otherwise(F.lit(1).cast("bigint"))
    ends = groups.select("lang", "source", F.lit("").alias("term"), absent.alias("p"))
    ends = ends.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rows = shares.select("lang", "source", "term", "p").withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
    sums = rows.unionByName(ends).groupBy("lang", "shard").applyInArrow(
        _shard_sums, "lang string, source string, item string, value bigint"
    )
    sums = materialize(sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pair-sums")
    turned = sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = sums.unionByName(turned).withColumn("rank", F.row_number().over(by_value))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(*columns)
        .unionByName(tops.withColumn("part", F.lit("term")).select(*columns))
    )
