"""Session helpers: local session, shared scratch folder, small-input spreading."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F

#: What a task of a fit may read, counting all numbers of a vector: tree learners lay out sparse ones in full.
TASK_BYTES = 512 << 20


def local_session(name: str = "larkspur", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benches."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LARKSPUR_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh
    temporary folder, kept for the rest of the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="larkspur-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/larkspur/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_copy(df: DataFrame, name: str = "stored") -> DataFrame:
    """The rows written to the shared folder and read back: made once, whatever reads them, and columns are read singly."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores of a local master on an input that is stored as fewer splits than there are cores.

    The small test tables are single row groups, which no read setting can split.  On a
    cluster every input is read as it is split, so no table is shuffled for this.
    """
    context = df.sparkSession.sparkContext
    if not context.master.startswith("local["):
        return df
    cores = context.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() <= cores else df


def _most_rows(data: DataFrame) -> int:
    """Rows of a task that reads no more than TASK_BYTES."""
    widths = [F.size(vector_to_array(f.name)) for f in data.schema if isinstance(f.dataType, VectorUDT)]
    first = data.select(F.greatest(F.lit(1), *widths)).first() if widths else None
    return max(1, TASK_BYTES // (8 * (first[0] if first else 1)))


@contextmanager
def fitting(df: DataFrame, *columns: str, rows_per_task: int = 2000) -> Iterator[DataFrame]:
    """The columns an iterative fit reads, cached and cut into as many tasks as they are worth.

    A fit runs one or two jobs per iteration, so a few rows are best kept in one
    task, while a cached join result that ended up in fewer tasks than there are
    cores is spread.  Inputs with many rows per task are left as they are, up to the rows that :data:`TASK_BYTES` hold:
    larger ones are cut into more tasks, so that what one task reads does not grow with the input.
    """
    data = df.select(*columns).cache()
    out = data
    try:
        rows = data.count()
        wanted = max(1, math.ceil(rows / rows_per_task))
        now = data.rdd.getNumPartitions()
        least = min(wanted, df.sparkSession.sparkContext.defaultParallelism)
        needed = math.ceil(rows / _most_rows(data))
        if now < needed:
            out = data.repartition(needed).cache()
            out.count()
            data.unpersist()
        elif now > wanted:
            out = data.coalesce(wanted)
        elif now < least:
            out = data.repartition(least).cache()
        # a view of the cached rows: estimators keep their own row objects only for
        # inputs that are not cached themselves, else they decode them every iteration
        yield out.select("*")
    finally:
        out.unpersist()
        data.unpersist()
