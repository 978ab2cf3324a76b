"""Feature stores, keyed tables, term-frequency and labelled-vector sinks, fitted models."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from larkspur.operators.corpus import upsert
from larkspur.session import stored_copy


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing the folder."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read a stored table, or build, store and read it when there is no complete one."""
    if not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# --- keyed tables -----------------------------------------------------------------

#: Folders of a keyed table; the number is part of their name, so an update finds the one the table was written with.
PARTS = 64
PART_NAME = re.compile(r"_part_of_(\d+)")


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _write_parts(df: DataFrame, path: str, name: str, mode: str) -> None:
    # one task and one file for each folder; keys are unique by now, so folders are alike in size
    dealt = df.repartition(F.col(name))
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path)


def write_keyed(df: DataFrame, path: str, key: str, order: str | None = None, parts: int = PARTS) -> None:
    """Store a table with one row for each key, dealt into ``parts`` folders by the hash of the key.

    Of rows that repeat a key that with the greatest ``order`` stands, and without it, or on ties, the greatest row.
    """
    name = f"_part_of_{parts}"
    single = upsert(df, df.limit(0), key, order).withColumn(name, _part(key, parts))
    _write_parts(single, path, name, "errorifexists")


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.drop(_part_column(rows))


def _part_column(rows: DataFrame) -> str:
    named = [c for c in rows.columns if PART_NAME.fullmatch(c)]
    if not named:
        raise ValueError("not a keyed table")
    return named[0]


def update_keyed(spark: SparkSession, path: str, updates: DataFrame, key: str, order: str | None = None) -> int:
    """Replace or add the rows of ``updates`` in a keyed table; the number of folders that were rewritten.

    Only the folders that hold a key of the updates are read and written; the files of all others keep their names.  An update stands over the
    stored row; of updates that repeat a key the one with the greatest ``order``, and without it, or on ties, the greatest row.  The new
    content of the touched folders is stored beside the table first, so it is complete before any of them is replaced.
    """
    stored = spark.read.parquet(path)
    name = _part_column(stored)
    parts = int(PART_NAME.fullmatch(name).group(1))
    columns = [c for c in stored.columns if c != name]
    fresh = stored_copy(updates.select(*columns).withColumn(name, _part(key, parts)), "updates")
    touched = sorted(r[0] for r in fresh.select(name).distinct().collect())  # at most ``parts`` rows
    if not touched:
        return 0
    base = stored.where(F.col(name).isin(touched)).select(*columns)
    merged = stored_copy(upsert(base, fresh.drop(name), key, order).withColumn(name, _part(key, parts)), "merged")
    _write_parts(merged, path, name, "overwrite")
    return len(touched)


# --- sinks --------------------------------------------------------------------------


def write_doc_freqs(df: DataFrame, path: str) -> None:
    """``term<TAB>frequency`` lines."""
    df.select("term", "df").write.option("sep", "\t").option("quote", "").csv(path)


def read_doc_freqs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("term string, df bigint").option("sep", "\t").option("quote", "").csv(path)


def export_labeled_vectors(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    """Sparse labelled vectors as text."""
    rows = df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
    rows.write.format("libsvm").save(path)


def read_labeled_vectors(spark: SparkSession, path: str, size: int) -> DataFrame:
    return spark.read.format("libsvm").option("numFeatures", str(size)).load(path)


def export_by_category(df: DataFrame, path: str, width: int, categories: Sequence[str], key: str = "doc_id", category: str = "category", features: str = "features") -> None:
    """One folder of sparse attribute-relation files for each category, all from one job.

    A folder ``category=<name>`` holds every row, labelled 1 if it is of that category and 0 if it is of another one.  Each file stands alone: it
    begins with the attributes, those of the vector and the class.  Rows are dealt by category and key, so a category
    fills as many files as there are tasks.
    """
    names = F.array(*[F.lit(c) for c in categories])
    vector = F.unwrap_udt(features)
    line = lambda i, x: F.when(x != 0, F.concat_ws(" ", i, x))
    cells = F.when(vector["type"] == 0, F.zip_with(vector["indices"], vector["values"], line)).otherwise(F.transform(vector["values"], lambda x, i: line(i, x)))
    rows = df.select(key, category, F.array_join(cells, ", ").alias("_cells"), F.explode(names).alias("_of"))
    mark = F.when(F.col(category).eqNullSafe(F.col("_of")), "1").otherwise("0")
    body = F.concat(F.lit("{"), F.when(F.col("_cells") != "", F.concat("_cells", F.lit(", "))).otherwise(""), F.lit(f"{width} "), mark, F.lit("}"))
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = rows.select("_of", F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt"), body.alias("value"))
    dealt = lines.repartition("_of", "_salt").sortWithinPartitions("_of").select("_of", "value")

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number = None, 0
        for batch in batches:
            of, text = batch["_of"].to_pylist(), batch["value"].to_pylist()
            out: tuple[list, list, list] = ([], [], [])
            for name, line in zip(of, text):
                if name != at:
                    at = name
                    quoted = name.replace("'", "\\'")
                    head = [f"@relation '{quoted}'", *(f"@attribute f{k} numeric" for k in range(width)), "@attribute class {0,1}", "@data"]
                else:
                    head = []
                for each in (*head, line):
                    number += 1
                    for column, value in zip(out, (name, number, each)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["category", "_line", "value"])

    # the order of lines is that of the writer, which sorts by category only where that is not done yet
    ready = dealt.mapInArrow(with_header, "category string, _line bigint, value string").sortWithinPartitions("category", "_line")
    ready.select("category", "value").write.partitionBy("category").text(path)


def read_by_category(spark: SparkSession, path: str) -> DataFrame:
    """(category, label, entries as (index, value)) of what export_by_category() wrote; the class is no entry."""
    rows = spark.read.schema("value string, category string").text(path).where("value like '{%'")
    cells = F.split(F.substring(F.col("value"), F.lit(2), F.length("value") - 2), ", ")
    pairs = F.transform(cells, lambda c: F.split(c, " "))
    entries = F.transform(F.slice(pairs, F.lit(1), F.size(pairs) - 1), lambda p: F.struct(p[0].cast("int").alias("index"), p[1].cast("double").alias("value")))
    return rows.select("category", F.element_at(pairs, -1)[1].cast("double").alias("label"), entries.alias("entries"))


def save_model(model, path: str, overwrite: bool = True) -> None:
    """Store a fitted indexer, pipeline or classifier."""
    writer = model.write().overwrite() if overwrite else model.write()
    writer.save(path)


def load_model(path: str, kind=PipelineModel):
    """Load a stored model; ``kind`` is its class."""
    return kind.load(path)


# the header writer travels with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
