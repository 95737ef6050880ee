"""Published states of a store: numbered files, each of which names all that belongs to the state.

Data goes to folders that no reader looks into until the next state names them. A reader resolves
the newest state once and then reads exactly its folders; a writer that fails, or repeats a run and
fails half-way, leaves the state as it is. A number can be taken only once, so of two writers that
start from the same state one fails.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

from oreworks.sinks.files import child_names, create_text, delete, read_text

_FOLDER = "_states"
#: Older states that stay, for readers that resolved one of them.
KEPT_STATES = 20


class ConcurrentWriteError(RuntimeError):
    """Another writer published a state in the meantime."""


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = child_names(spark, f"{root}/{_FOLDER}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _path(root: str, number: int) -> str:
    return f"{root}/{_FOLDER}/{number:012d}.json"


def latest(spark: SparkSession, root: str) -> tuple[int, dict[str, Any]]:
    """Number and content of the newest state; 0 and nothing where there is none.

    A state that a writer has not finished is not one yet.
    """
    for number in reversed(_numbers(spark, root)):
        try:
            return number, json.loads(read_text(spark, _path(root, number)))
        except json.JSONDecodeError:
            continue
    return 0, {}


def publish(spark: SparkSession, root: str, after: int, state: dict[str, Any]) -> int:
    """Make ``state`` the newest one, if ``after`` still is; returns its number."""
    numbers = _numbers(spark, root)
    number = max([after, *numbers]) + 1
    if latest(spark, root)[0] != after or not create_text(spark, _path(root, number), json.dumps(state)):
        raise ConcurrentWriteError(f"{root} has a state after {after}")
    for old in numbers[: -KEPT_STATES]:
        delete(spark, _path(root, old))
    return number
