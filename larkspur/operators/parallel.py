"""Run independent fits side by side: each submits its own Spark jobs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

A = TypeVar("A")
B = TypeVar("B")


def run_all(task: Callable[[A], B], items: Iterable[A], parallelism: int = 4) -> list[B]:
    """Results in the order of the items; the first failure is raised."""
    items = list(items)
    if parallelism < 2 or len(items) < 2:
        return [task(i) for i in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.getActiveSession())(task), items))


def at_once(data: DataFrame, most: int) -> int:
    """How many fits over ``data`` run side by side: as many as give each core two tasks, so few where one fit has tasks for all cores.

    Every fit keeps a copy of the rows in its own form; copies that no core is waiting for only take memory.
    """
    cores = data.sparkSession.sparkContext.defaultParallelism
    return max(1, min(most, math.ceil(2 * cores / max(1, data.rdd.getNumPartitions()))))
