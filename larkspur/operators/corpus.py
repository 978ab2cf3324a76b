"""Corpus shaping: labels, filters, content, keyed updates, rating clean-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from larkspur.functions.hashing import bucket
from larkspur.functions.text import any_of, drop_words, letters_only


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def label_one_vs_other(df: DataFrame, category: str, top: list[str], topics: str = "topics", out: str = "category") -> DataFrame:
    """``category`` where the topics name it (and it is a top topic), else "other"."""
    hit = F.array_contains(F.array_intersect(topics, _array(top)), category)
    return df.withColumn(out, F.when(hit, category).otherwise("other"))


def label_top_category(df: DataFrame, top: list[str], topics: str = "topics", out: str = "category") -> DataFrame:
    """The first top topic in the document's own order; documents without one are dropped."""
    first = F.get(F.array_intersect(topics, _array(top)), F.lit(0))
    return df.withColumn(out, first).filter(F.col(out).isNotNull())


def parse_corpus(df: DataFrame, top: list[str], topic: str | None = None, topics: str = "topics") -> DataFrame:
    """Label a corpus against one topic, or against all top topics when none is given."""
    docs = build_content(df)
    if topic is None:
        return label_top_category(docs, top, topics)
    return label_one_vs_other(docs, topic, top, topics)


def filter_top_topics(df: DataFrame, top: list[str], topics: str = "topics") -> DataFrame:
    """Documents whose topics meet the list."""
    return df.filter(F.arrays_overlap(topics, _array(top)))


def build_content(df: DataFrame, body: str = "body", title: str = "title", out: str = "content") -> DataFrame:
    """Body directly followed by the title; a missing part counts as empty."""
    return df.withColumn(out, F.concat(F.coalesce(body, F.lit("")), F.coalesce(title, F.lit(""))))


def prefix_tags(df: DataFrame, tags: str, out: str, prefix: str = "label:") -> DataFrame:
    return df.withColumn(out, F.transform(tags, lambda t: F.concat(F.lit(prefix), t)))


def filter_terms(df: DataFrame, tokens: str, stop_words: list[str], min_length: int = 3, min_terms: int = 2) -> DataFrame:
    """Keep letter-only terms that are long enough and no stop words, then documents with enough terms."""
    lowered = sorted({w.lower() for w in stop_words})

    def keep(term: Column) -> Column:
        fits = F.length(term) >= min_length
        if lowered:
            fits = fits & ~F.lower(term).isin(lowered)
        return fits & letters_only(term)  # the dearest test last

    kept = F.filter(tokens, keep)
    return df.withColumn(tokens, kept).filter(F.size(tokens) >= min_terms)


#: Words up to which a list is put into the expression; a longer one is joined.
LITERAL_WORDS = 10_000


def remove_words(df: DataFrame, key: str, tokens: str, words: DataFrame, most: int = LITERAL_WORDS) -> DataFrame:
    """``df`` with the tokens left whose lower-case form is not in a list of words, of any length: column ``word``.

    The list is measured first.  A short one becomes a literal, and nothing is shuffled.  A longer one never reaches the driver: tokens
    are laid out with their places, those in the list drop out by an anti-join, and the others are put together again in
    order.  Both ways give the same rows.  ``key`` must be unique; null tokens stay.
    """
    lowered = words.select(F.lower("word").alias("_word")).distinct()
    few = lowered.limit(most + 1).collect()  # at most one more than the limit
    if len(few) <= most:
        return df.withColumn(tokens, drop_words(tokens, [r["_word"] for r in few]))
    laid = df.select(key, F.posexplode(tokens).alias("_at", "_token"))
    left = laid.withColumn("_word", F.lower("_token")).join(lowered, "_word", "left_anti")
    kept = left.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_at", "_token"))).alias("_kept"))
    none = F.when(F.col(tokens).isNotNull(), F.array().cast(df.schema[tokens].dataType))
    joined = df.join(kept, key, "left").withColumn(tokens, F.coalesce(F.col("_kept._token"), none))
    return joined.select(*df.columns)


def bucket_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """Sample without replacement: the rows whose key falls in the first ``percent`` of 100 buckets."""
    return df.filter(bucket(F.col(key), 100) < percent)


def seeded_sample(df: DataFrame, fraction: float, seed: int = 11) -> DataFrame:
    """Sample without replacement by Spark's sampler; not comparable across partitionings."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def upsert(base: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Keyed update: one row per key, the update where there is one.

    A ``max_by`` aggregate picks the winner, so many rows of one key shrink to one
    per task before the shuffle.  Among repeats on one side the row with
    the greatest ``order`` wins (a column of both sides), and without it, or on ties, the greatest row.
    """
    values = [c for c in base.columns if c != key]
    sides = base.withColumn("_side", F.lit(0)).unionByName(updates.withColumn("_side", F.lit(1)))
    row = F.struct(*values)
    won = sides.groupBy(key).agg(F.max(F.struct(F.col("_side"), (F.col(order) if order else F.lit(0)).alias("order"), row.alias("row"))).alias("_w"))
    return won.select(key, "_w.row.*").select(*base.columns)


def subtract_rows(df: DataFrame, removed: DataFrame) -> DataFrame:
    """Rows of ``df`` that do not occur in ``removed``; repeats among the others stay."""
    gone = removed.select(*df.columns).distinct().alias("r")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in df.columns])
    return df.alias("l").join(gone, same, "left_anti")


def union_parts(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def binarize_ratings(df: DataFrame, rating: str = "rating", middle: float = 2.5, out: str = "relevant") -> DataFrame:
    """1.0 where the rating lies above the middle, else 0.0."""
    return df.withColumn(out, F.when(F.col(rating) - middle > 0, 1.0).otherwise(0.0))


def clamp(df: DataFrame, column: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    return df.withColumn(column, F.least(F.greatest(F.col(column), F.lit(low)), F.lit(high)))


def containing_any(df: DataFrame, array: str, values: list[str]) -> DataFrame:
    """Rows whose array column contains one of the values."""
    return df.filter(any_of([F.array_contains(array, v) for v in values]))
