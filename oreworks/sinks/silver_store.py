"""Silver history on plain Parquet folders, in buckets of keys, published by manifest.

The state of a store (:mod:`oreworks.sinks.manifest`) lists its runs. Each run has a folder of its
own, ``<root>/run=<label>/take=<id>/is_current=<bool>/bucket=<n>/``: the versions that it closed,
and the open versions of the buckets that its keys fall into, as they are after the run. A merge
reads and writes only these buckets; the open versions of all others stay with the runs that wrote
them last. Nothing written is part of the store before a new state names it, so a failed run, or a
repeated one that fails half-way, changes nothing.

Runs of :func:`merge_observations` also keep what they observed, in the same buckets. Late rows make
the versions of their keys again, from the observations in their buckets alone; such a run is
``whole`` for these buckets: it holds their closed versions too, and older ones are not read any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.config import SPIKE_STDDEVS, TRACKED_COLUMNS
from oreworks.functions import ts_literal
from oreworks.operators.history import VERSION_COLUMNS, latest_per_key, scd2_chain, scd2_changes
from oreworks.sinks import manifest
from oreworks.sinks.files import child_names, delete, materialize, observed_counts
from oreworks.sinks.tables import with_flag

CHANGES = ("new", "version", "closed", "carried")
#: Buckets of a new store. One should hold what a task handles well; see :func:`rebucket`.
BUCKETS = 8

_LABEL_TIME = "t%Y%m%dT%H%M%S%f"
_ISO = "%Y-%m-%dT%H:%M:%S.%f"
_BUCKET, _SEEN_TO, _REAL = "_bucket", "_seen_to", "_real"


class LateBatchError(ValueError):
    """The batch is older than the last committed run."""


class FreedRunError(ValueError):
    """The open versions of a run are needed that were freed."""


@dataclass(frozen=True)
class SnapshotLimits:
    """Which value of a snapshot is flagged: above mean + ``width`` deviations of its ``group``."""

    value: str = "total_volume"
    group: str = "market_cap_category"
    output: str = "is_volume_spike"
    width: float = SPIKE_STDDEVS


Run = dict[str, Any]


def run_label(run_ts: datetime, suffix: str = "") -> str:
    label = run_ts.strftime(_LABEL_TIME)
    return f"{label}-{suffix}" if suffix else label


def committed_runs(spark: SparkSession, root: str) -> list[str]:
    return [r["label"] for r in manifest.latest(spark, root)[1].get("runs", [])]


def _bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _buckets_in(path: str, spark: SparkSession) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in child_names(spark, path) if n.startswith(f"{_BUCKET}="))


def _holders(runs: Sequence[Run], wanted: Iterable[int] | None = None) -> dict[int, Run]:
    """For each bucket the last run that wrote its open versions."""
    wanted = None if wanted is None else set(wanted)
    found: dict[int, Run] = {}
    for run in reversed(runs):
        for b in run["touched"]:
            if b not in found and (wanted is None or b in wanted):
                found[b] = run
    return found


def _open_rows(runs: Sequence[Run]) -> int:
    return runs[-1]["open_rows"] if runs else 0


def _slices(spark: SparkSession, root: str, schema: T.StructType, chosen: dict[str, tuple[Run, set[int]]], flag: str) -> list[DataFrame]:
    """Rows of some buckets of some runs; only their folders are listed."""
    if not chosen:
        return []
    fields = [f for f in schema.fields if f.name not in ("is_current", "run", "take", _BUCKET)]
    parts = [T.StructField(n, T.StringType()) for n in ("run", "take", "is_current")]
    full = T.StructType([*fields, *parts, T.StructField(_BUCKET, T.IntegerType())])
    paths = [f"{root}/run={r['label']}/take={r['take']}/is_current={flag}" for r, _ in chosen.values()]
    rows = spark.read.option("basePath", root).schema(full).parquet(*paths)
    have = "open" if flag == "true" else "closed"
    partly = {label: set(r[have]) - buckets for label, (r, buckets) in chosen.items()}
    left_out = [(F.col("run") == label) & F.col(_BUCKET).isin(sorted(b)) for label, b in partly.items() if b]
    if left_out:
        rows = rows.filter(~reduce(Column.__or__, left_out))
    return [with_flag(rows, "is_current").drop("run", "take")]


def _open(spark: SparkSession, root: str, state: dict, runs: Sequence[Run], buckets: Iterable[int] | None = None) -> DataFrame | None:
    """Open versions after the last of some runs, of all buckets or some."""
    chosen: dict[str, tuple[Run, set[int]]] = {}
    for b, run in _holders(runs, buckets).items():
        if b in run["freed"]:
            raise FreedRunError(f"open versions of run {run['label']} were freed; a later run has them")
        if b in run["open"]:
            chosen.setdefault(run["label"], (run, set()))[1].add(b)
    found = _slices(spark, root, _schema(state), chosen, "true")
    return found[0] if found else None


def _closed(spark: SparkSession, root: str, state: dict, runs: Sequence[Run], buckets: Iterable[int] | None = None) -> DataFrame | None:
    """Closed versions after the last of some runs."""
    wanted = None if buckets is None else set(buckets)
    over: set[int] = set()
    chosen: dict[str, tuple[Run, set[int]]] = {}
    for run in reversed(runs):
        mine = {b for b in run["closed"] if b not in over and (wanted is None or b in wanted)}
        if mine:
            chosen[run["label"]] = (run, mine)
        over |= set(run["whole"])
    found = _slices(spark, root, _schema(state), chosen, "false")
    return found[0] if found else None


def _schema(state: dict) -> T.StructType:
    return T.StructType.fromJson(state["schema"])


def _shown(rows: DataFrame, spark: SparkSession, root: str, state: dict, runs: Sequence[Run]) -> DataFrame:
    """Versions as readers see them: without the store's own columns, flagged by whole snapshots."""
    return _with_limits(rows, spark, root, state, runs).drop("change", _BUCKET, _SEEN_TO)


def read_current(spark: SparkSession, root: str, run: str | None = None) -> DataFrame | None:
    """Open versions after a run, by default the last one; only their folders are read."""
    _, state = manifest.latest(spark, root)
    runs = _up_to(state, run)
    rows = _open(spark, root, state, runs) if runs else None
    if rows is None and runs:  # all versions are closed
        return read_versions(spark, root).filter("false")
    return rows if rows is None else _shown(rows, spark, root, state, runs)


def _up_to(state: dict, label: str | None) -> list[Run]:
    runs = state.get("runs", [])
    if label is None:
        return runs
    at = [r["label"] for r in runs].index(label)
    return runs[: at + 1]


def read_versions(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    """Every version after a run, by default the last one: open ones and closed ones."""
    _, state = manifest.latest(spark, root)
    runs = _up_to(state, run)
    parts = [p for p in (_open(spark, root, state, runs), _closed(spark, root, state, runs)) if p is not None]
    return _shown(reduce(DataFrame.unionByName, parts), spark, root, state, runs)


def read_run(spark: SparkSession, root: str, run: str) -> DataFrame:
    """What one run wrote, with the ``change`` of each version."""
    _, state = manifest.latest(spark, root)
    own = _up_to(state, run)[-1]
    parts = []
    for flag, have in (("true", "open"), ("false", "closed")):
        chosen = {run: (own, set(own[have]))} if own[have] else {}
        parts += _slices(spark, root, _schema(state), chosen, flag)
    return reduce(DataFrame.unionByName, parts).drop(_BUCKET, _SEEN_TO)


def merge_batch(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    run_ts: datetime,
    key: Sequence[str] = ("coin_id",),
    tracked: Sequence[str] = TRACKED_COLUMNS,
    close_missing: bool = False,
    suffix: str = "",
    buckets: int = BUCKETS,
) -> dict[str, int]:
    """Merge a batch as one run and return the number of versions per kind of change.

    Runs come in the order of their time, and of their suffix where the time is the same (parts of
    one extraction). The same time and suffix again replaces that run, unless what it starts from
    was freed (:func:`drop_superseded`), which raises. Rows with a null key part have no history:
    they go to ``<root>_rejected/run=<label>``. A batch that leaves no version at all makes no run.

    Only the buckets of the batch's keys are read and written, all of them with ``close_missing``.
    ``buckets`` holds for a new store.
    """
    number, state = manifest.latest(spark, root)
    label = run_label(run_ts, suffix)
    runs = [r for r in state.get("runs", []) if r["label"] != label]
    if runs and runs[-1]["label"] > label:
        raise LateBatchError(f"run {label} is not later than {runs[-1]['label']}")
    state = state or {"buckets": buckets, "runs": []}
    bucket = _bucket_of(key, state["buckets"])
    batch = _with_key(batch, key, f"{root}_rejected/run={label}")
    current, touched = None, None
    if runs:
        # Reads the keys alone.
        touched = {r[0] for r in batch.select(bucket).distinct().collect()}
        if close_missing:
            touched |= set(_holders(runs))
        current = _open(spark, root, state, runs, touched)
        current = current if current is None else current.drop("change", _BUCKET)
    changes = scd2_changes(current, latest_per_key(batch, key), run_ts, key, tracked, close_missing)
    found, run = _write_run(changes, root, label, key, state["buckets"], touched)
    if run is None:
        return found
    # Open versions in other buckets are carried too, without being read.
    found["carried"] = _open_rows(runs) - found["closed"]
    run["reached"] = dict.fromkeys(map(str, run["touched"]), run_ts.strftime(_ISO))
    run.pop("open_written")
    run["open_rows"] = found["carried"] + found["version"] + found["new"]
    _publish(spark, root, number, state, runs, run, changes.schema)
    return found


def merge_observations(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    part: str,
    key: Sequence[str] = ("coin_id",),
    tracked: Sequence[str] = TRACKED_COLUMNS,
    time: str = "extracted_at",
    limits: SnapshotLimits | None = None,
    buckets: int = BUCKETS,
) -> dict[str, int]:
    """Merge rows observed at any times as one run and return the versions per kind of change.

    Every row counts at its own ``time``; of rows with the same key and time, whether they come in
    one batch or in several, the newest counts (:func:`latest_per_key`). So the history does not
    depend on how rows arrive. ``part`` names the batch; the last one again replaces its own run.

    Keys whose rows are all later than anything seen of them go on from their open version. The
    versions of other keys are made again from their observations, which stand in the same buckets;
    no other bucket is read. Rows without a time or key part go to ``<root>_rejected/run=<part>``.

    With ``limits``, snapshots (rows of one time) are flagged by all their rows, those of other
    batches too: the limits of the batch's snapshots are kept, and readers compare with the last ones.
    """
    number, state = manifest.latest(spark, root)
    labels = [r["part"] == part for r in state.get("runs", [])]
    if any(labels[:-1]):
        raise LateBatchError(f"part {part} is not the last one")
    runs = state["runs"][:-1] if labels and labels[-1] else list(state.get("runs", []))
    state = state or {"buckets": buckets, "runs": []}
    bucket = _bucket_of(key, state["buckets"])
    batch = _with_key(batch, [*key, time], f"{root}_rejected/run={part}").drop(*VERSION_COLUMNS)
    take = uuid.uuid4().hex
    observed = f"{root}/observed/take={take}"
    rows = latest_per_key(batch, [*key, time]).withColumn(_BUCKET, bucket)
    ordered = rows.hint("rebalance", F.col(_BUCKET)).sortWithinPartitions(_BUCKET, *key, time)
    ordered.write.partitionBy(_BUCKET).parquet(observed)
    rows = _observed(spark, [observed], rows.schema)
    spans = rows.groupBy(_BUCKET).agg(F.min(time).alias("a"), F.max(time).alias("b")).collect()
    if not spans:
        delete(spark, observed)
        return dict.fromkeys(CHANGES, 0)

    touched = {r[_BUCKET] for r in spans}
    reached: dict[int, datetime] = {}
    for run in runs:
        for b, at in run["reached"].items():
            reached[int(b)] = max(reached.get(int(b), datetime.min), datetime.strptime(at, _ISO))
    last = max(r["b"] for r in spans)
    newest = max([last, *[datetime.strptime(r["label"].split("-")[0], _LABEL_TIME) for r in runs[-1:]]])
    run_more = {
        "part": part,
        "observed": observed,
        "first": min(r["a"] for r in spans).strftime(_ISO),
        "last": last.strftime(_ISO),
        "reached": {str(r[_BUCKET]): r["b"].strftime(_ISO) for r in spans},
    }
    seen_schema = _united(state.get("observed_schema"), rows.schema)
    current = _open(spark, root, state, runs, touched) if runs else None
    current = current if current is None else current.drop("change", _BUCKET, "valid_to", "is_current")
    doubtful = [r[_BUCKET] for r in spans if r["a"] <= reached.get(r[_BUCKET], datetime.min)]
    late = _late_keys(rows, current, key, time, doubtful) if doubtful else None
    late_buckets = sorted(r[0] for r in late.select(_bucket_of(key, state["buckets"])).distinct().collect()) if late else []
    own = rows.drop(_BUCKET)
    if not late_buckets:
        changes = scd2_chain(current, own, key, tracked, time, _SEEN_TO, unique=True)
    else:
        on_time = own.join(late, list(key), "left_anti")
        others = current if current is None else current.join(late, list(key), "left_anti")
        changes = scd2_chain(others, on_time, key, tracked, time, _SEEN_TO, unique=True)
        again, kept = _made_again(spark, root, state, runs, rows, late, late_buckets, key, tracked, time, seen_schema)
        changes = changes.unionByName(again, allowMissingColumns=True)
        if kept is not None:
            changes = changes.unionByName(kept, allowMissingColumns=True)
    found, run = _write_run(changes, root, run_label(newest, part), key, state["buckets"], touched, late_buckets)
    if run is None:
        return found
    written = run.pop("open_written")
    if late_buckets:
        elsewhere = _open_rows(runs) - (current.count() if current is not None else 0)  # from file footers
        found["carried"] += elsewhere
        run_more["open_rows"] = elsewhere + written
    else:
        found["carried"] = _open_rows(runs) - found["closed"]
        run_more["open_rows"] = _open_rows(runs) + found["new"]
    if limits:
        run_more["limits"] = _write_limits(spark, root, state, runs, run_more, rows, seen_schema, key, time, limits)
        state["limits"] = {"value": limits.value, "group": limits.group, "output": limits.output, "time": time}
    state["observed_schema"] = seen_schema.jsonValue()
    _publish(spark, root, number, state, runs, run | run_more, changes.schema)
    return found


def _observed(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Observations of some runs."""
    fields = [f for f in schema.fields if f.name != _BUCKET]
    parts = [T.StructField("take", T.StringType()), T.StructField(_BUCKET, T.IntegerType())]
    base = paths[0].rpartition("/")[0]
    return spark.read.option("basePath", base).schema(T.StructType([*fields, *parts])).parquet(*paths).drop("take")


def _united(known: dict | None, schema: T.StructType) -> T.StructType:
    """Columns of all batches so far."""
    fields = {f.name: f for f in (T.StructType.fromJson(known).fields if known else [])}
    return T.StructType(list((fields | {f.name: f for f in schema.fields}).values()))


def _late_keys(rows: DataFrame, current: DataFrame | None, key: Sequence[str], time: str, buckets: list[int]) -> DataFrame:
    """Keys with a row that is not later than all seen of them, or of which that is not known."""
    first = rows.filter(F.col(_BUCKET).isin(buckets)).groupBy(*key).agg(F.min(time).alias("_first"))
    if current is not None and _SEEN_TO in current.columns:
        known = current.filter(F.col(_SEEN_TO).isNotNull()).select(*key, F.col(_SEEN_TO))
        first = first.join(known, list(key), "left").filter(F.col(_SEEN_TO).isNull() | (F.col("_first") <= F.col(_SEEN_TO)))
    return materialize(first.select(*key), "late-keys")


def _made_again(spark, root, state, runs, rows, late, buckets, key, tracked, time, schema) -> tuple[DataFrame, DataFrame | None]:
    """All versions of late keys, made again, and the closed versions of the other keys of their buckets."""
    in_buckets = F.col(_BUCKET).isin(buckets)
    paths = [r["observed"] for r in runs if r.get("observed") and set(buckets) & set(map(int, r["reached"]))]
    seen = rows.filter(in_buckets)
    if paths:
        seen = seen.unionByName(_observed(spark, paths, schema).filter(in_buckets), allowMissingColumns=True)
    seen = seen.drop(_BUCKET).join(late, list(key), "left_semi").withColumn(_REAL, F.lit(True))
    open_, closed = (read(spark, root, state, runs, buckets) if runs else None for read in (_open, _closed))
    for versions in (open_, closed):
        if versions is None:
            continue
        # Versions from merges of another kind have no observation: each stands for one at its start.
        starts = versions.join(late, list(key), "left_semi").withColumn(time, F.col("valid_from"))
        starts = starts.drop(*VERSION_COLUMNS, "change", _BUCKET, _SEEN_TO).withColumn(_REAL, F.lit(False))
        seen = seen.unionByName(starts, allowMissingColumns=True)
    seen = latest_per_key(seen, [*key, time], [_REAL, "last_updated", "extracted_at"]).drop(_REAL)
    again = scd2_chain(None, seen, key, tracked, time, _SEEN_TO, unique=True)
    kept = None
    if closed is not None:
        kept = closed.drop(_BUCKET).join(late, list(key), "left_anti").withColumn("change", F.lit("kept"))
    return again, kept


def _write_limits(spark, root, state, runs, own, rows, schema, key, time, limits: SnapshotLimits) -> str:
    """Flag limits of every snapshot that the batch has rows of, from all its rows so far."""
    near = [r["observed"] for r in runs if r.get("observed") and r["first"] <= own["last"] and r["last"] >= own["first"]]
    seen = rows.select(*key, time, *[c for c in ("last_updated",) if c in rows.columns and c not in (*key, time)], limits.value, limits.group)
    if near:
        times = rows.select(time).distinct()
        first, last = (ts_literal(datetime.strptime(own[c], _ISO)) for c in ("first", "last"))
        before = _observed(spark, near, schema).filter(F.col(time).between(first, last)).join(times, time, "left_semi")
        every = rows.unionByName(before, allowMissingColumns=True).drop(_BUCKET)
        seen = latest_per_key(every, [*key, time])
    above = F.avg(limits.value) + F.lit(limits.width) * F.stddev_samp(limits.value)
    found = seen.groupBy(F.col(time).alias("_at"), F.col(limits.group).alias("_group")).agg(above.alias("_above"))
    path = f"{root}/limits/take={uuid.uuid4().hex}"
    found.withColumn("_nth", F.lit(len(runs))).coalesce(1).write.parquet(path)
    return path


def _with_limits(rows: DataFrame, spark: SparkSession, root: str, state: dict, runs: Sequence[Run]) -> DataFrame:
    """Flags by the last known limits of each version's snapshot; versions of other merges keep theirs."""
    paths = [r["limits"] for r in runs if r.get("limits")]
    if not paths:
        return rows
    known, output = state["limits"], state["limits"]["output"]
    found = spark.read.schema("_at timestamp_ntz, _group string, _above double, _nth int").parquet(*paths)
    newest = found.groupBy("_at", "_group").agg(F.max_by("_above", "_nth").alias("_above"), F.lit(True).alias("_known"))
    match = (F.col("valid_from") == F.col("_at")) & F.col(known["group"]).cast("string").eqNullSafe(F.col("_group"))
    flag = F.coalesce(F.col(known["value"]) > F.col("_above"), F.lit(False))
    own = F.col(output) if output in rows.columns else F.lit(False)
    flagged = rows.join(newest, match, "left").withColumn(output, F.when(F.col("_known"), flag).otherwise(own))
    return flagged.drop("_at", "_group", "_above", "_known")


def _with_key(batch: DataFrame, key: Sequence[str], rejected: str) -> DataFrame:
    """Rows with all parts of the key; the others are written to a table of their own."""
    keyed = F.lit(True)
    for k in key:
        keyed = keyed & F.col(k).isNotNull()
    if not any(batch.schema[k].nullable for k in key):
        return batch
    batch.filter(~keyed).write.mode("overwrite").parquet(rejected)
    return batch.filter(keyed)


def _write_run(
    changes: DataFrame,
    root: str,
    label: str,
    key: Sequence[str],
    buckets: int,
    touched: Iterable[int] | None = None,
    whole: Sequence[int] = (),
) -> tuple[dict[str, int], Run | None]:
    """Write the versions of a run to a folder of its own; what it touched is what it wrote if not given."""
    spark = changes.sparkSession
    seen = Observation()
    take = uuid.uuid4().hex
    path = f"{root}/run={label}/take={take}"
    placed = changes.withColumn(_BUCKET, _bucket_of(key, buckets))
    placed = placed.hint("rebalance", F.col("is_current"), F.col(_BUCKET))
    counted = placed.sortWithinPartitions("is_current", _BUCKET, *key, "valid_from").observe(
        seen, *[F.count_if(F.col("change") == c).alias(c) for c in CHANGES], F.count_if("is_current").alias("open_written")
    )
    counted.write.partitionBy("is_current", _BUCKET).parquet(path)
    found = observed_counts(seen, (*CHANGES, "open_written"))
    open_written = found.pop("open_written")
    if not any(found.values()):
        delete(spark, path)
        return found, None
    slices = {have: _buckets_in(f"{path}/is_current={flag}", spark) for have, flag in (("open", "true"), ("closed", "false"))}
    wrote = set(slices["open"]) | set(slices["closed"])
    run = {"label": label, "take": take, "part": None, "freed": [], "whole": sorted(whole), "open_written": open_written}
    return found, run | slices | {"touched": sorted(wrote | set(touched or ()))}


def _publish(spark: SparkSession, root: str, number: int, state: dict, runs: Sequence[Run], run: Run, schema: T.StructType) -> None:
    kept = _united(state.get("schema"), T.StructType([f for f in schema.fields if f.name not in ("is_current", _BUCKET)]))
    manifest.publish(spark, root, number, state | {"schema": kept.jsonValue(), "runs": [*runs, run]})


def drop_superseded(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Free open versions that none of the last ``keep`` states needs; the history stays complete.

    Returns the number of runs that lost some. Folders of runs that were replaced go too.
    """
    number, state = manifest.latest(spark, root)
    runs: list[Run] = state.get("runs", [])
    needed: dict[str, set[int]] = {}
    for end in range(max(1, len(runs) - keep + 1), len(runs) + 1):
        for b, run in _holders(runs[:end]).items():
            needed.setdefault(run["label"], set()).add(b)
    freed: dict[str, list[int]] = {}
    for run in runs:
        gone = [b for b in run["open"] if b not in needed.get(run["label"], set()) and b not in run["freed"]]
        if gone:
            freed[run["label"]] = gone
    if freed:
        after = [r | {"freed": sorted({*r["freed"], *freed.get(r["label"], ())})} for r in runs]
        manifest.publish(spark, root, number, state | {"runs": after})
    for run in runs:
        folder = f"{root}/run={run['label']}"
        for b in freed.get(run["label"], ()):
            delete(spark, f"{folder}/take={run['take']}/is_current=true/{_BUCKET}={b}")
        for name in child_names(spark, folder):
            if name.startswith("take=") and name != f"take={run['take']}":
                delete(spark, f"{folder}/{name}")
    return len(freed)


def rebucket(spark: SparkSession, root: str, buckets: int, key: Sequence[str] = ("coin_id",)) -> None:
    """Write the whole store anew in another number of buckets, as one run with the last label.

    Versions, observations and limits stay the same; states before it stay readable until cleaned up.
    """
    number, state = manifest.latest(spark, root)
    runs = state["runs"]
    parts = [p for p in (_open(spark, root, state, runs), _closed(spark, root, state, runs)) if p is not None]
    versions = reduce(DataFrame.unionByName, parts).drop(_BUCKET).withColumn("change", F.lit("carried"))
    _, run = _write_run(versions, root, runs[-1]["label"], key, buckets, range(buckets), range(buckets))
    reached = max(at for r in runs for at in r["reached"].values())
    run |= {"reached": dict.fromkeys(map(str, range(buckets)), reached), "open_rows": run.pop("open_written")}
    seen = [r for r in runs if r.get("observed")]
    if seen:
        rows = _observed(spark, [r["observed"] for r in seen], T.StructType.fromJson(state["observed_schema"]))
        run["observed"] = f"{root}/observed/take={uuid.uuid4().hex}"
        rows = rows.withColumn(_BUCKET, _bucket_of(key, buckets)).hint("rebalance", F.col(_BUCKET))
        rows.sortWithinPartitions(_BUCKET, *key).write.partitionBy(_BUCKET).parquet(run["observed"])
        run |= {"first": min(r["first"] for r in seen), "last": max(r["last"] for r in seen)}
    paths = [r["limits"] for r in runs if r.get("limits")]
    if paths:
        run["limits"] = f"{root}/limits/take={uuid.uuid4().hex}"
        limits = spark.read.parquet(*paths).groupBy("_at", "_group").agg(F.max_by("_above", "_nth").alias("_above"))
        limits.withColumn("_nth", F.lit(0)).write.parquet(run["limits"])
    manifest.publish(spark, root, number, state | {"buckets": buckets, "runs": [run]})
