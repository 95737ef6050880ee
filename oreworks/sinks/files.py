"""Shared folders and the few file-system calls the writers need."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="oreworks-")
        spark.conf.set(_CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/oreworks/{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the one the session names for checkpoints, which all executors reach.

    Only a local session without that setting gets a folder of its own.
    """
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove all that this application put under the checkpoint folder; call it at the end."""
    return delete(spark, _scratch_root(spark))


_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def freed_after(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`materialize` writes inside the block go at its end.

    For steps that repeat for as long as an application lives, and that leave nothing behind but
    what they write elsewhere.
    """
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            delete(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read more than once and go on from the written table.

    Unlike a cache it survives lost executors and later reads are column-pruned.
    """
    path = shared_dir(df.sparkSession, name)
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    fs, target = _path(spark, path)
    return fs.getContentSummary(target).getLength()


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark that readers of the folder don't list as data."""
    fs, target = _path(spark, path)
    fs.create(target, True).close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, target = _path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that is not there yet; false where it is."""
    fs, target = _path(spark, path)
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or fs.exists(target):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def move_files(spark: SparkSession, source: str, target: str) -> int:
    """Move the files of a folder into another of the same file system; data is not rewritten.

    Writers give every file a name of its own, so nothing is replaced, and a repeated call after a
    failure moves what is left.
    """
    fs, folder = _path(spark, source)
    _, destination = _path(spark, target)
    fs.mkdirs(destination)
    names = child_names(spark, source)
    for name in names:
        _, old = _path(spark, f"{source}/{name}")
        _, new = _path(spark, f"{target}/{name}")
        if not fs.rename(old, new):
            raise OSError(f"could not move {source}/{name} to {target}")
    fs.delete(folder, True)
    return len(names)


def observed_counts(seen: Observation, names: Sequence[str]) -> dict[str, int]:
    """Counts taken by a finished write. A write without any input task reports no row: zeros."""
    try:
        found = seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        found = {}
    return {n: int(found.get(n) or 0) for n in names}
