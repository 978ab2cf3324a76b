"""Document sources: JSON lines, JSON arrays, articles, XML pages, word lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from larkspur.functions.text import clean_text

NEWS_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("places", T.ArrayType(T.StringType())),
        T.StructField("organisations", T.ArrayType(T.StringType())),
        T.StructField("id", T.IntegerType()),
    ]
)

ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
    ]
)

# What a missing field of a labelled post is replaced with.
POST_DEFAULTS = {"category": "other", "content": "other", "title": "other", "labels": "empty"}


def read_news(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines news documents."""
    return spark.read.schema(NEWS_SCHEMA).json(path)


def parse_news(df: DataFrame, line: str = "value") -> DataFrame:
    """The same from a string column."""
    return df.select(F.from_json(line, NEWS_SCHEMA).alias("_d")).select("_d.*")


def read_news_arrays(spark: SparkSession, path: str) -> DataFrame:
    """A folder of files that each hold one JSON array of documents: one row for each element.

    A file is read by one task, which takes the array apart element by element; no row ever holds the array.
    """
    return spark.read.schema(NEWS_SCHEMA).option("multiLine", True).json(path)


def parse_news_arrays(df: DataFrame, line: str = "value") -> DataFrame:
    """A string column that holds a JSON array of documents per row."""
    items = F.from_json(line, T.ArrayType(NEWS_SCHEMA))
    return df.select(F.explode(items).alias("_d")).select("_d.*")


def write_news_arrays(docs: DataFrame, path: str, key: str = "id", size: int = 64) -> None:
    """A folder of files that each hold one JSON array of up to ``size`` documents with neighbouring keys."""
    columns = F.struct(*docs.columns)
    packed = docs.groupBy(F.floor(F.col(key) / size).alias("_pack")).agg(F.to_json(F.sort_array(F.collect_list(columns))).alias("value"))
    packed.select("value").write.option("maxRecordsPerFile", 1).text(path)


def clean_news(docs: DataFrame, top_topics: list[str]) -> DataFrame:
    """Keep documents with a body and a top topic; take newlines and U+0003 out of the body."""
    kept = docs.filter(F.col("body").isNotNull() & F.arrays_overlap("topics", _words(top_topics)))
    return kept.withColumn("body", clean_text("body", newline=""))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def with_defaults(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """Replace missing fields of labelled posts by their fixed defaults."""
    return df.fillna(POST_DEFAULTS if defaults is None else defaults)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines articles, content followed by a newline and the title."""
    return spark.read.schema(ARTICLE_SCHEMA).json(path).withColumn("content", _article_content())


def parse_articles(df: DataFrame, line: str = "value") -> DataFrame:
    parsed = df.select(F.from_json(line, ARTICLE_SCHEMA).alias("_d")).select("_d.*")
    return parsed.withColumn("content", _article_content())


def read_xml_pages(spark: SparkSession, path: str, schema: str, row_tag: str = "page") -> DataFrame:
    """One row per ``row_tag`` element.  Every file needs a single root element."""
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreSurroundingSpaces", "false")
        .schema(schema)
        .load(path)
    )


def write_xml_pages(df: DataFrame, path: str, row_tag: str = "page", root_tag: str = "dump") -> None:
    df.write.format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def stop_word_table(spark: SparkSession, path: str) -> DataFrame:
    """A word list of any length, one word per line, as a table: (word)."""
    return spark.read.text(path).select(F.col("value").alias("word")).where("word <> ''")


def read_stop_words(spark: SparkSession, path: str, limit: int = 100_000) -> list[str]:
    """A word list, one word per line.  It ends up in task closures, so its size is checked."""
    words = [r[0] for r in spark.read.text(path).limit(limit + 1).collect()]
    if len(words) > limit:
        raise ValueError(f"more than {limit} stop words")
    return words


def _article_content() -> Column:
    return F.concat_ws("\n", "content", "title")


def _words(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])
