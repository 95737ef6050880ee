"""Near copies of vectors: spherical k-means cells, blocked cosine products inside them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.llm.shared import components, forest, in_blocks
from oreworks.sinks.files import materialize

THRESHOLD = 0.93
#: Vectors per cell aimed at, most cells, and cells that each vector is compared in.
CELL_VECTORS = 512
MAX_CELLS = 4096
PROBES = 4
#: The centroids are fitted to about so many vectors; every vector is assigned.
SAMPLE_VECTORS = 32_768
ROUNDS = 8


def unit_rows(rows: np.ndarray) -> np.ndarray:
    rows = np.asarray(rows, dtype=np.float64)
    # By the largest component first: squares of very large or small ones leave the range of doubles.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spherical_kmeans(rows: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit rows. A cell that loses all its rows keeps its centroid."""
    rng = np.random.default_rng(seed)
    centroids = rows[rng.choice(len(rows), size=min(cells, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate(
            [np.argmax(rows[a : a + 4096] @ centroids.T, axis=1) for a in range(0, len(rows), 4096)]
        )
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        norms = np.linalg.norm(sums, axis=1)
        centroids[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return centroids


def _usable(vec: str):
    """Not null, some component not zero, all finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return finite & F.exists(vec, lambda x: x != 0)


def _fit(distinct: DataFrame, sample_size: int, cell_vectors: int, max_cells: int) -> np.ndarray | None:
    total = distinct.count()
    step = max(1, total // sample_size)
    chosen = distinct.filter(F.pmod(F.xxhash64("vec"), F.lit(step)) == 0).select("vec")
    found = [r.vec for r in chosen.limit(2 * sample_size).collect()]
    if not found:
        return None
    sizes = pd.Series([len(v) for v in found])
    dim = sizes.mode()[0]  # vectors of other lengths share one cell per length
    rows = unit_rows([v for v in found if len(v) == dim])
    return spherical_kmeans(rows, int(np.clip(total // cell_vectors, 1, max_cells)))


def _assigned(centroids: np.ndarray | None, probes: int):
    """Cells of each vector, best first; the cell -1 takes lengths that the centroids don't have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec").to_pylist()
            cells: list[list[int]] = [[-1]] * len(vecs)
            fit = [] if centroids is None else [i for i, v in enumerate(vecs) if len(v) == centroids.shape[1]]
            for at in range(0, len(fit), 2048):
                part = fit[at : at + 2048]
                near = unit_rows([vecs[i] for i in part]) @ centroids.T
                n = min(probes, centroids.shape[0])
                best = np.argpartition(-near, n - 1, axis=1)[:, :n]
                for i, own in zip(part, best.tolist(), strict=True):
                    cells[i] = own
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int32()))], [*batch.schema.names, "cells"]
            )

    return run


def _shared_earlier(a: np.ndarray, b: np.ndarray, cell: int) -> np.ndarray:
    """Whether two rows of cell numbers have a common cell below ``cell``."""
    low_a, low_b = np.where(a < cell, a, -2), np.where(b < cell, b, -3)
    return (low_a[:, :, None] == low_b[:, None, :]).any(axis=(1, 2))


def _compare(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        low, high, cell = int(group["low"].iat[0]), int(group["high"].iat[0]), int(group["cell"].iat[0])
        group = group.sort_values(["block", "node"], kind="stable")
        first = group[group["block"] == low]
        second = first if low == high else group[group["block"] == high]
        out = {"a": [], "b": [], "links": []}
        if len(first) and len(second):
            width = max(group["cells"].map(len))
            pad = lambda cells: np.array([[*c, *[-9] * (width - len(c))] for c in cells])
            x, y = unit_rows(list(first["vec"])), unit_rows(list(second["vec"]))
            cx, cy = pad(first["cells"]), pad(second["cells"])
            ids_x, ids_y = first["node"].to_numpy(), second["node"].to_numpy()
            n_x, n_y = first["copies"].to_numpy(), second["copies"].to_numpy()
            degree_x, degree_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
            tree: dict[int, int] = {}
            for at in range(0, len(x), 256):
                i, j = np.nonzero(x[at : at + 256] @ y.T >= threshold)
                i = i + at
                keep = i < j if low == high else np.ones(len(i), bool)
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                known = np.array(list(tree.items()), dtype=np.int64).reshape(-1, 2)
                tree = forest(np.concatenate([known[:, 0], ids_x[i]]), np.concatenate([known[:, 1], ids_y[j]]))
                for part in range(0, len(i), 100_000):  # a pair counts in its first common cell only
                    pi, pj = i[part : part + 100_000], j[part : part + 100_000]
                    own = ~_shared_earlier(cx[pi], cy[pj], cell)
                    np.add.at(degree_x, pi[own], n_y[pj[own]])
                    np.add.at(degree_y, pj[own], n_x[pi[own]])
            for ids, degree in ((ids_x, degree_x), (ids_y, degree_y)):
                out["a"] += ids[degree > 0].tolist()
                out["b"] += [None] * int((degree > 0).sum())
                out["links"] += degree[degree > 0].tolist()
            out["a"] += list(tree)
            out["b"] += list(tree.values())
            out["links"] += [0] * len(tree)
        return pd.DataFrame(
            {"a": pd.array(out["a"], "Int64"), "b": pd.array(out["b"], "Int64"), "links": pd.array(out["links"], "Int64")}
        )

    return run


def linked_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    probes: int = PROBES,
    cell_vectors: int = CELL_VECTORS,
    max_cells: int = MAX_CELLS,
    sample_size: int = SAMPLE_VECTORS,
) -> DataFrame:
    """``(id, n_links, component, kept)`` per row, links being cosines of ``threshold`` or more.

    Equal vectors of a label are one vector with a number of copies, so copies never meet as pairs.
    Each distinct vector is compared in its ``probes`` nearest cells; cells are compared block by
    block, so a cell of any size is split, and only link counts and a forest leave a task. A pair
    in several cells counts once. Pairs that share no cell are not found (see the measured recall).
    Centroids come from a bounded sample of about ``sample_size`` vectors.

    Rows whose label, id or vector is null, whose vector is zero or empty, or holds a null or
    non-finite component link with nothing: no links, their own component, kept. Vectors of
    different lengths never link. Repeated rows are vectors of their own, and so are rows that
    repeat an id with another vector: the graph's nodes are distinct vectors, not ids.
    """
    vec = F.col(vec_col).cast("array<double>")
    every = rows.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("vec"), F.col(label_col).alias("label"))
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable("vec"), F.lit(False))
    every = every.withColumn("usable", usable)
    good = every.filter("usable")
    distinct = good.groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    # The number is written once with its vector, so all later steps read the same one.
    distinct = materialize(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    fitted = _fit(distinct, sample_size, cell_vectors, max_cells)
    kind = distinct.schema["label"].dataType.simpleString()
    cells = distinct.select("label", "vec", "node", "copies").mapInArrow(
        _assigned(fitted, probes),
        f"label {kind}, vec array<double>, node bigint, copies bigint, cells array<int>",
    )
    spread = cells.withColumn("cell", F.explode("cells")).withColumn("dim", F.size("vec"))
    dealt = in_blocks(spread, ["label", "dim", "cell"], "vec", 1024)
    met = dealt.groupBy("label", "dim", "cell", "low", "high").applyInPandas(
        _compare(threshold), "a bigint, b bigint, links bigint"
    )
    met = materialize(met, "vector-links")
    degrees = met.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    tops = components(met.filter("b IS NOT NULL"), "a", "b").withColumnsRenamed({"node": "a", "component": "top"})
    numbered = distinct.select("node", "least").join(tops, F.col("node") == F.col("a"), "left")
    numbered = materialize(numbered.select("node", "least", F.coalesce("top", "node").alias("top")), "vector-tops")
    # The smallest id of each component; vectors without links to others keep their own.
    named = numbered.groupBy("top").agg(F.min("least").alias("component"))
    named = numbered.join(named, "top").select(F.col("node").alias("_node"), "component")
    per_vector = (
        distinct.join(degrees, F.col("node") == F.col("a"), "left")
        .join(named, F.col("node") == F.col("_node"))
        .select(
            F.col("label").alias("_label"),
            F.col("vec").alias("_vec"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            "component",
        )
    )
    linked = good.join(per_vector, (F.col("label") == F.col("_label")) & (F.col("vec") == F.col("_vec")))
    out = linked.select("id", "n_links", "component").unionByName(
        every.filter("NOT usable").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    )
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
