"""How the test tables stand in for the inputs the operators expect."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.functions.vectors import as_vector, doubles
from larkspur.operators import clustering, features
from larkspur.session import shared_dir, spread
from larkspur.sources.stores import load_or_build

# A small supplied stop-word list for the four languages of the test documents.
STOP_WORDS = [
    "the", "and", "of", "to", "in", "is", "that", "for", "it", "with", "as", "was",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "qui", "par", "avec",
    "der", "die", "das", "und", "ist", "nicht", "mit", "ein", "eine", "für", "sich",
    "el", "los", "las", "y", "en", "por", "con", "para", "una", "del",
]

# The topics that count as top topics on the test documents.
TOP = ["fr", "src3", "de", "src7", "src12"]

DOCS_SQL = """docs as (
  select doc_id, text as content, lang as category, split_part(text, chr(10), 1) as title,
         lang || ' ' || source as labels, [lang, source] as topics
  from documents)"""

PLAYS_SQL = """plays as (
  select o_custkey as "user", l_partkey as item, sum(l_quantity) as rating
  from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)"""

RATED_SQL = """rated as (
  select o_custkey as "user", l_partkey as item, ceil(avg(l_quantity) / 10) as rating
  from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)"""

CENTRES_SQL = """cells as (
  select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as d from embeddings),
centres as (select label as cluster, d, avg(x) as m from cells group by 1, 2),
dists as (
  select vec_id, cells.label, cluster, sqrt(sum((x - m) * (x - m))) as distance
  from cells join centres using (d) group by 1, 2, 3),
nearest as (
  select * from dists qualify row_number() over (partition by vec_id order by round(distance, 9), cluster) = 1)"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with content, category, title, labels and topics."""
    rows = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return spread(rows).select(
        "doc_id",
        F.col("text").alias("content"),
        F.col("lang").alias("category"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat_ws(" ", "lang", "source").alias("labels"),
        F.array("lang", "source").alias("topics"),
    )


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with its order's priority and its part's attributes."""
    lines = spread(table(spark, sf, "lineitem").drop("l_shipdate"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    parts = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).join(
        parts, lines["l_partkey"] == parts["p_partkey"]
    )


def _stored(spark: SparkSession, name: str, sf: str) -> str:
    """Path of a table that is built once per application and state of its input, and shared by the jobs that start from it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    state = sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)
    key = hashlib.md5(repr(state).encode()).hexdigest()[:12]
    return f"{shared_dir(spark).rstrip('/')}/larkspur/{spark.sparkContext.applicationId}/{name}-{key}"


def _purchases(spark: SparkSession, sf: str) -> DataFrame:
    """(user, item, quantity, lines): orders joined to their lines and combined, stored on first use."""

    def build() -> DataFrame:
        lines = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"))
        orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
        both = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        groups = both.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        return groups.agg(F.sum("l_quantity").alias("quantity"), F.count("*").alias("lines"))

    return spread(load_or_build(spark, _stored(spark, "purchases", sf), build))


def plays(spark: SparkSession, sf: str) -> DataFrame:
    """(user, item, rating): how much of a part a customer ordered."""
    return _purchases(spark, sf).select("user", "item", F.col("quantity").alias("rating"))


def rated(spark: SparkSession, sf: str) -> DataFrame:
    """(user, item, rating) on a 1 to 5 scale."""
    stars = F.ceil(F.col("quantity") / F.col("lines") / 10).cast("double")
    return _purchases(spark, sf).select("user", "item", stars.alias("rating"))


def items(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.array("p_type", "p_brand").alias("genres"))


def names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread(table(spark, sf, "embeddings"))
    return rows.select("vec_id", "label", doubles("embedding").alias("features"))


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with the closest per-label mean as their cluster, and the distance to it."""
    rows = vectors(spark, sf)
    ids, centres = clustering.group_means(rows, "label", "features")
    return clustering.assign_clusters(rows, centres, ids)


def ml_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors(spark, sf).withColumn("features", as_vector("features"))


def measurement_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric and categorical columns with a label, as one table."""
    return order_lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_linestatus", "o_orderpriority", "p_type",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    )


def feature_set(spark: SparkSession, sf: str) -> DataFrame:
    """Stored document features, built on first use and then shared by all fits.

    The assembled vector holds content and title; the tag vector is stored beside it.
    """
    def build() -> DataFrame:
        content, title, tags = features.content_recipe(STOP_WORDS), features.title_recipe(STOP_WORDS), features.tag_recipe()
        assembled = {features.FEATURES: [content.out, title.out]}
        return features.build_features(docs(spark, sf), [content, title, tags], ["doc_id", "category", "labels"], assembled)[1]

    return spread(load_or_build(spark, _stored(spark, "features", sf), build))
