"""Spark helpers shared by the operators: buckets, scratch tables, checkpoints."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import FloatType

from larkspur.session import cut_lineage, scratch_path

__all__ = ["bucket_count", "bucket_of", "cut", "documents", "labelled_vectors", "scratch_path", "text_of"]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def bucket_count(spark: SparkSession, per_partition: int = 4) -> int:
    """Buckets for work that is dealt out by hash: a few for each shuffle partition.

    ``spark.sql.shuffle.partitions`` is set to suit the input, so a bucket keeps its
    size when both grow.
    """
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(texts: DataFrame, per_partition: int = 4, size: int = 64 << 20) -> int:
    """As many buckets, or more where the texts would fill them with over ``size`` bytes each."""
    held = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(bucket_count(texts.sparkSession, per_partition), -(-held // size))


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def text_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text alone (null text: empty); rows without an id are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more).where("doc_id is not null")


def cut(df: DataFrame) -> DataFrame:
    """A written copy in the shared folder: later steps read it and nothing is computed twice.

    Parquet in the folder of ``spark.checkpoint.dir``: it outlives executors.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of steps that are written: Spark drops them once the driver has collected their plans as garbage."""
    spark.sparkContext._jvm.System.gc()


def reliable(df: DataFrame) -> DataFrame:
    return cut_lineage(df)


def one_per_id(docs: DataFrame) -> DataFrame:
    """One whole row of each id where ids repeat: that with the smallest text (null: empty), of equal texts that with the smallest hash of its columns.

    A table whose ids are unique, as they should be, is returned as it is.  Rows without an id stay out.
    """
    docs = docs.where("doc_id is not null")
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs
    names = [F.col(f"`{c}`") for c in docs.columns]
    order = F.struct(F.coalesce("text", F.lit("")), F.xxhash64(*names))
    return docs.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(F.struct(*names), order).alias("_row")).select("_row.*")


def labelled_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, label, v) of embeddings with an id; of rows that repeat an id that with the smallest label and vector stands.

    Components are floats where the table has floats, else doubles.
    """
    rows = table.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("v"))
    if not isinstance(table.schema["embedding"].dataType.elementType, FloatType):
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    if rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        return rows
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.*")


def fold(ids: Column) -> Column:
    """Bits of an id folded onto each other; fold_array() is the same for numpy."""
    return ids.bitwiseXOR(F.shiftrightunsigned(ids, 9)).bitwiseXOR(F.shiftrightunsigned(ids, 21))


def fold_array(ids: np.ndarray) -> np.ndarray:
    u = ids.view(np.uint64)
    return (u ^ (u >> np.uint64(9)) ^ (u >> np.uint64(21))).view(np.int64)
