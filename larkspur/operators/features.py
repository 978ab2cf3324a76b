"""Text and vector features as ``pyspark.ml`` stages, with an owned vocabulary."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    IDFModel,
    IndexToString,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    SQLTransformer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.functions.text import ngrams_sql
from larkspur.functions.vectors import as_vector, sparse_entries
from larkspur.session import stored_copy

# Sizes and document-frequency floors of the three text vocabularies.
CONTENT_TERMS, TITLE_TERMS, TAG_TERMS = 2000, 800, 400
CONTENT_MIN_DOCS, TITLE_MIN_DOCS, TAG_MIN_DOCS = 3, 2, 1
#: Words that the n-grams of a vocabulary may be made of; where more are as frequent, all n-grams are counted.
MAX_FREQUENT = 100_000
LABEL, FEATURES, PREDICTION = "categoryIndex", "normIdfFeatures", "prediction"


# --- labels -----------------------------------------------------------------


def index_labels(df: DataFrame, column: str = "category", out: str = LABEL) -> StringIndexerModel:
    """Index labels by falling frequency, equal counts in alphabetical order."""
    return StringIndexer(inputCol=column, outputCol=out, stringOrderType="frequencyDesc").fit(df)


def unindex_labels(df: DataFrame, labels: Sequence[str], column: str = PREDICTION, out: str = "predictedLabel") -> DataFrame:
    return IndexToString(inputCol=column, outputCol=out, labels=list(labels)).transform(df)


def label_distribution(df: DataFrame, column: str = "category") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def labeled_points(df: DataFrame, label: str = LABEL, features: str = FEATURES) -> DataFrame:
    return df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))


# --- vocabulary and weights --------------------------------------------------


def with_counts(df: DataFrame, tokens: str, out: str = "_counts") -> DataFrame:
    """Add the distinct tokens of a row with their numbers: an array of (term, tf).

    Equal tokens are neighbours once the array is sorted, so runs of it are the counts; no shuffle.
    """
    n = F.size("_sorted")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    begins = F.filter(places, lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)))
    laid = df.withColumn("_sorted", F.sort_array(tokens)).withColumn("_begins", begins)
    runs = F.transform("_begins", lambda p, k: F.struct(F.get("_sorted", p).alias("term"), (F.coalesce(F.get("_begins", k + 1), n) - p).cast("bigint").alias("tf")))
    return laid.withColumn(out, runs).drop("_sorted", "_begins")


def term_statistics(df: DataFrame, tokens: str) -> DataFrame:
    """``term``, ``tf`` (all occurrences), ``df`` (documents that have it), ``squares`` (sum of squared counts).

    All that vocabularies, document weights and deviations need, from one pass and one shuffle on the
    term with partial sums; no shuffle by document.  A row counts as one document.
    """
    # the outer form: for the other one the optimizer tests the array for emptiness first, and to that end makes it twice
    each = with_counts(df.select(F.col(tokens).alias("_tokens")), "_tokens").select(F.inline_outer("_counts")).where("term is not null")
    tf = F.col("tf")
    return each.groupBy("term").agg(F.sum(tf).alias("tf"), F.count("*").alias("df"), F.sum(tf * tf).alias("squares"))


def document_frequencies(df: DataFrame, tokens: str) -> DataFrame:
    """``term``, ``tf`` (all occurrences), ``df`` (documents that have it)."""
    return term_statistics(df, tokens).select("term", "tf", "df")


@dataclass
class TermTable:
    """The terms of a vocabulary, in its order, with their statistics over ``n`` documents."""

    terms: list[str]
    tf: list[int]
    df: list[int]
    squares: list[int]
    n: int

    def idf(self, min_docs: int = 3) -> list[float]:
        """Weight of each term: ln((n + 1) / (df + 1)), 0 for a term in fewer than ``min_docs`` documents."""
        return [math.log((self.n + 1) / (d + 1)) if d >= min_docs else 0.0 for d in self.df]

    def per_deviation(self) -> list[float]:
        """One over the sample standard deviation of each term's count, over all documents; 0 where it does not vary."""
        spread = [(self.n * q - t * t) / (self.n * (self.n - 1)) if self.n > 1 else 0.0 for t, q in zip(self.tf, self.squares)]
        return [1 / math.sqrt(v) if v > 0 else 0.0 for v in spread]


def term_table(df: DataFrame, tokens: str, size: int, min_docs: int) -> TermTable:
    """The vocabulary with everything that is fitted on it; as many rows are collected as it has terms."""
    chosen = term_statistics(df, tokens).filter(F.col("df") >= min_docs).orderBy(F.desc("tf"), F.asc("term")).limit(size)
    rows = sorted(chosen.collect(), key=lambda r: (-r["tf"], r["term"].encode()))
    return TermTable([r["term"] for r in rows], [r["tf"] for r in rows], [r["df"] for r in rows], [r["squares"] for r in rows], df.count())


def _in_order(terms: list[tuple]) -> list[tuple]:
    """Rows of (term, tf, ...) as a vocabulary has them: by falling tf, then by the bytes of the term."""
    return sorted(terms, key=lambda r: (-r[1], r[0].encode()))


def frequent_ngrams(df: DataFrame, words: str, n: int, size: int, min_docs: int) -> tuple[list[str], int, bool] | None:
    """The ``size`` most frequent 1- to ``n``-grams of a word column, without counting all n-grams.

    Each occurrence of an n-gram is one of all its words, so an n-gram that is found ``floor`` times is made of words found
    as often.  With the tf of the word in place ``size`` as the floor, few words are left, and the n-grams counted are at most
    the combinations of these, however large the input is.  Returns the terms, the floor, and whether these are all terms with
    that tf; None where more than MAX_FREQUENT words reach the floor.  Words must not hold spaces.
    """
    spark = df.sparkSession
    counts = df.select(F.explode(words).alias("term")).where("term is not null").groupBy("term").agg(F.count("*").alias("tf"))
    counts = stored_copy(counts.where(F.col("tf") >= min_docs), "words")
    first = [(r["term"], r["tf"]) for r in counts.orderBy(F.desc("tf"), "term").limit(size).collect()]
    floor = max(min_docs, first[-1][1]) if len(first) == size else min_docs
    common = [(r["term"], r["tf"]) for r in counts.where(F.col("tf") >= floor).limit(MAX_FREQUENT + 1).collect()]
    if len(common) > MAX_FREQUENT:
        return None
    found = list(common)
    names = F.broadcast(spark.createDataFrame([(at, w) for at, (w, _) in enumerate(common)], "at int, word string"))
    for level in range(2, n + 1):
        length = F.greatest(F.size(words) - (level - 1), F.lit(0))
        columns = [F.slice(words, k + 1, length).alias(f"w{k}") for k in range(level)]
        grams = df.select(F.explode(F.arrays_zip(*columns)).alias("_g")).select("_g.*")
        for k in range(level):
            grams = grams.join(names.select(F.col("at").alias(f"a{k}"), F.col("word").alias(f"w{k}")), f"w{k}").drop(f"w{k}")
        places = [f"a{k}" for k in range(level)]
        often = grams.groupBy(*places).agg(F.count("*").alias("tf")).where(F.col("tf") >= floor)
        for k in range(level):
            often = often.join(names.select(F.col("at").alias(f"a{k}"), F.col("word").alias(f"w{k}")), f"a{k}")
        often = often.select(F.concat_ws(" ", *[f"w{k}" for k in range(level)]).alias("term"), "tf")
        found += [(r["term"], r["tf"]) for r in often.orderBy(F.desc("tf"), "term").limit(size + 1).collect()]
    return [term for term, _ in _in_order(found)[:size]], floor, len(found) <= size


def ngram_table(df: DataFrame, words: str, terms: str, n: int, size: int, min_docs: int) -> TermTable:
    """As :func:`term_table`, for n-grams of a word column: the same rows, but only n-grams that may be among them are counted.

    Twice as many terms as asked for are looked at, as some are found in too few documents; where that does not settle it, all are counted.
    """
    chosen = frequent_ngrams(df, words, n, 2 * size, min_docs)
    if chosen is None:
        return term_table(df, terms, size, min_docs)
    candidates, floor, complete = chosen
    vectors = count_vectorizer(candidates, terms, "_v").transform(df.select(terms))
    value = F.col("value").cast("bigint")
    sums = sparse_entries(vectors, "_v").groupBy("index").agg(F.sum(value).alias("tf"), F.count("*").alias("df"), F.sum(value * value).alias("squares"))
    # as many rows as there are candidates
    rows = [(candidates[r["index"]], r["tf"], r["df"], r["squares"]) for r in sums.collect() if candidates and r["df"] >= min_docs]
    rows = _in_order(rows)[:size]
    if len(rows) < size and not (complete and floor <= min_docs):
        return term_table(df, terms, size, min_docs)
    return TermTable([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows], df.count())


def build_vocabulary(df: DataFrame, tokens: str, size: int, min_docs: int) -> DataFrame:
    """The ``size`` most frequent terms found in at least ``min_docs`` documents.

    Ordered by occurrences, then by term, so the result does not depend on
    partitioning.  ``limit`` after ``orderBy`` keeps only ``size`` rows per task.
    """
    terms = document_frequencies(df, tokens).filter(F.col("df") >= min_docs)
    return terms.orderBy(F.desc("tf"), F.asc("term")).limit(size)


def vocabulary_terms(df: DataFrame, tokens: str, size: int, min_docs: int) -> list[str]:
    rows = build_vocabulary(df, tokens, size, min_docs).collect()
    return [r["term"] for r in sorted(rows, key=lambda r: (-r["tf"], r["term"].encode()))]


def count_vectorizer(vocabulary: list[str], tokens: str, out: str) -> CountVectorizerModel:
    """Term counts over a given vocabulary; an empty vocabulary is padded, its vector stays empty."""
    return CountVectorizerModel.from_vocabulary(vocabulary or ["\x00"], inputCol=tokens, outputCol=out)


def term_counts(df: DataFrame, key: str, tokens: str, vocabulary: list[str]) -> DataFrame:
    """Long form (key, term, tf) of the term-count vectors."""
    vectors = count_vectorizer(vocabulary, tokens, "_tf").transform(df)
    return with_terms(sparse_entries(vectors, "_tf", key), vocabulary).withColumnRenamed("value", "tf")


def with_terms(entries: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Replace a vector index by the vocabulary term at that index."""
    names = entries.sparkSession.createDataFrame(list(enumerate(vocabulary)), "index int, term string")
    # at most as many rows as the vocabulary has terms
    return entries.join(F.broadcast(names), "index").drop("index")


def fit_idf(df: DataFrame, column: str, out: str, min_docs: int = 3) -> IDFModel:
    return IDF(inputCol=column, outputCol=out, minDocFreq=min_docs).fit(df)


def weighted(factors: Sequence[float], column: str, out: str) -> ElementwiseProduct:
    """A stage that multiplies each entry of a count vector by the weight of its term; an empty vocabulary is padded."""
    return ElementwiseProduct(inputCol=column, outputCol=out, scalingVec=Vectors.dense(list(factors) or [0.0]))


def l1_normalizer(column: str, out: str) -> Normalizer:
    return Normalizer(inputCol=column, outputCol=out, p=1.0)


def unit_std(column: str, out: str) -> StandardScaler:
    """Divide by the sample standard deviation without centring, so sparse stays sparse."""
    return StandardScaler(inputCol=column, outputCol=out, withStd=True, withMean=False)


# --- pipelines ----------------------------------------------------------------


def whitespace_words(column: str = "content", out: str = "words") -> Tokenizer:
    return Tokenizer(inputCol=column, outputCol=out)


def regex_words(column: str, out: str, min_length: int, lower: bool) -> RegexTokenizer:
    return RegexTokenizer(
        inputCol=column, outputCol=out, pattern=r"\w+", gaps=False, minTokenLength=min_length, toLowercase=lower
    )


def stop_word_remover(column: str, out: str, stop_words: list[str] | None) -> StopWordsRemover:
    """Case-insensitive; without a list the built-in English one is used."""
    words = stop_words or StopWordsRemover.loadDefaultStopWords("english")
    return StopWordsRemover(inputCol=column, outputCol=out, stopWords=words, caseSensitive=False)


def ngram_stage(column: str, out: str, n: int = 2) -> SQLTransformer:
    """1..n-grams as a stage that is saved and loaded with its pipeline."""
    return SQLTransformer(statement=f"SELECT *, {ngrams_sql(column, n)} AS {out} FROM __THIS__")


def concat_stage(first: str, second: str, out: str) -> SQLTransformer:
    """Two string or array columns as one token array, as a pipeline stage."""
    return SQLTransformer(statement=f"SELECT *, split(concat_ws(' ', {first}, {second}), ' ') AS {out} FROM __THIS__")


@dataclass
class TextRecipe:
    """How one text column becomes a scaled term-count vector."""

    column: str
    out: str
    prefix: str
    size: int
    min_docs: int
    min_length: int
    lower: bool
    stop_words: list[str] | None = field(default_factory=list)
    n: int = 2
    index: str | None = None  # label column to index, if any

    @property
    def words(self) -> str:
        return f"{self.prefix}words"

    @property
    def terms(self) -> str:
        return f"{self.prefix}ngrams" if self.n > 1 else self.words

    @property
    def kept(self) -> str:
        """The words that terms are made of."""
        return f"{self.prefix}filteredWords" if self.n > 1 else self.words

    @property
    def counts(self) -> str:
        return f"{self.prefix}tfFeatures"

    @property
    def scratch(self) -> list[str]:
        """Columns made on the way that nothing later needs."""
        return [self.words, f"{self.prefix}filteredWords", f"{self.prefix}ngrams", self.counts]


def content_recipe(stop_words=None, size: int = CONTENT_TERMS, column: str = "content") -> TextRecipe:
    return TextRecipe(column, "content_features", "", size, CONTENT_MIN_DOCS, 3, False, stop_words, 2, "category")


def title_recipe(stop_words=None, size: int = TITLE_TERMS, column: str = "title") -> TextRecipe:
    return TextRecipe(column, "title_Features", "title_", size, TITLE_MIN_DOCS, 3, True, stop_words, 2)


def tag_recipe(size: int = TAG_TERMS, column: str = "labels") -> TextRecipe:
    return TextRecipe(column, "tag_features", "tag_", size, TAG_MIN_DOCS, 2, True, None, 1)


def token_stages(recipe: TextRecipe) -> list:
    """Tokens, stop words, n-grams.  The tag recipe has neither stop words nor n-grams."""
    stages = [regex_words(recipe.column, recipe.words, recipe.min_length, recipe.lower)]
    if recipe.n > 1:
        filtered = f"{recipe.prefix}filteredWords"
        stages.append(stop_word_remover(recipe.words, filtered, recipe.stop_words))
        stages.append(ngram_stage(filtered, recipe.terms, recipe.n))
    return stages


def vector_stages(recipe: TextRecipe, table: TermTable) -> list:
    """Counts over the vocabulary and unit deviation, both from the term table: nothing is left to be fitted."""
    return [count_vectorizer(table.terms, recipe.terms, recipe.counts), weighted(table.per_deviation(), recipe.counts, recipe.out)]


def _table_of(tokens: DataFrame, recipe: TextRecipe) -> TermTable:
    if recipe.n > 1:
        return ngram_table(tokens, recipe.kept, recipe.terms, recipe.n, recipe.size, recipe.min_docs)
    return term_table(tokens, recipe.terms, recipe.size, recipe.min_docs)


def _label_stages(df: DataFrame, recipe: TextRecipe) -> list:
    return [index_labels(df, recipe.index, LABEL)] if recipe.index else []


def fit_text(df: DataFrame, recipe: TextRecipe) -> PipelineModel:
    """Fit one text pipeline: label index, tokens, stop words, n-grams, counts, unit std.  The text is tokenised once."""
    stages = token_stages(recipe)
    table = _table_of(PipelineModel(stages).transform(df), recipe)
    return PipelineModel([*_label_stages(df, recipe), *stages, *vector_stages(recipe, table)])


def fit_features(
    df: DataFrame, recipes: Sequence[TextRecipe], out: str = FEATURES, last: Callable[[], list] | None = None
) -> PipelineModel:
    """Fit several text pipelines and assemble their vectors, all as one pipeline model.

    ``last`` may add further stages (a classifier, say) to be fitted on the assembled column.
    """
    stages: list = []
    for recipe in recipes:
        stages += fit_text(df, recipe).stages
    stages.append(VectorAssembler(inputCols=[r.out for r in recipes], outputCol=out))
    return Pipeline(stages=stages + (last() if last else [])).fit(df)


def build_features(df: DataFrame, recipes: Sequence[TextRecipe], keep: Sequence[str], out: dict[str, Sequence[str]] | None = None) -> tuple[PipelineModel, DataFrame]:
    """The fitted pipeline and the features of ``df`` itself, from tokens that are made and stored once.

    Words without stop words are stored (n-grams are rebuilt from them); statistics and vectors both read them.
    ``out`` names assembled columns and the recipes' columns that go into each.
    """
    labels = [stage for r in recipes for stage in _label_stages(df, r)]
    kept_labels = [r.index for r in recipes if r.index and r.index not in keep]
    stages = {r.prefix: token_stages(r) for r in recipes}
    # the last stage of a recipe with n-grams only puts words together
    words = PipelineModel([s for r in recipes for s in (stages[r.prefix][:-1] if r.n > 1 else stages[r.prefix])])
    stored = stored_copy(words.transform(df).select(*keep, *kept_labels, *[r.kept for r in recipes]))
    grams = PipelineModel([stages[r.prefix][-1] for r in recipes if r.n > 1]).transform(stored)
    vectors = [v for r in recipes for v in vector_stages(r, _table_of(grams, r))]
    vectors += [VectorAssembler(inputCols=list(columns), outputCol=name) for name, columns in (out or {FEATURES: [r.out for r in recipes]}).items()]
    model = PipelineModel([*labels, *[s for r in recipes for s in stages[r.prefix]], *vectors])
    made = PipelineModel([*labels, *vectors]).transform(grams)
    return model, made.drop(*kept_labels, *[c for r in recipes for c in r.scratch])


def feature_columns(df: DataFrame, model: PipelineModel, recipes: Sequence[TextRecipe]) -> DataFrame:
    """Transform and drop the columns made on the way."""
    return model.transform(df).drop(*[c for r in recipes for c in r.scratch])


def extract_words(df: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Single-step form: label index, lower-cased white-space tokens, stop words removed."""
    indexed = index_labels(df).transform(df)
    words = whitespace_words().transform(indexed)
    return stop_word_remover("words", "filteredWords", stop_words).transform(words)


def tf_idf(
    train: DataFrame, others: Sequence[DataFrame], tokens: str, vocabulary: list[str], out: str = FEATURES, min_docs: int = 3
) -> list[DataFrame]:
    """TF-IDF with L1 normalisation; document frequencies come from ``train`` only."""
    counts = term_statistics(train, tokens)
    names = train.sparkSession.createDataFrame(list(enumerate(vocabulary)), "_at int, term string")
    # as many rows as the vocabulary has terms
    found = {r["_at"]: r["df"] for r in counts.join(F.broadcast(names), "term").select("_at", "df").collect()}
    table = TermTable(vocabulary, [], [found.get(k, 0) for k in range(len(vocabulary))], [], train.count())
    stages = PipelineModel([
        count_vectorizer(vocabulary, tokens, "tfFeatures"), weighted(table.idf(min_docs), "tfFeatures", "idfFeatures"), l1_normalizer("idfFeatures", out),
    ])
    return [stages.transform(part) for part in (train, *others)]


# --- numeric features ------------------------------------------------------------


def one_hot(df: DataFrame, numeric: Sequence[str], categories: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns with full one-hot groups inserted after the first of them.

    Category ids are alphabetical; a value not seen in fitting is an error.
    """
    indexes = [f"_{c}_index" for c in categories]
    groups = [f"_{c}_hot" for c in categories]
    stages = Pipeline(
        stages=[
            StringIndexer(inputCols=list(categories), outputCols=indexes, stringOrderType="alphabetAsc", handleInvalid="error"),
            OneHotEncoder(inputCols=indexes, outputCols=groups, dropLast=False, handleInvalid="error"),
            VectorAssembler(inputCols=[numeric[0], *groups, *numeric[1:]], outputCol=out),
        ]
    )
    return stages.fit(df).transform(df).drop(*indexes, *groups)


def un_one_hot(df: DataFrame, features: str = "features", numeric: int = 10, groups: Sequence[int] = (4, 40)) -> DataFrame:
    """Collapse one-hot groups to the index of their 1; the first ``numeric`` values stay."""
    parts, start = [F.slice(features, 1, numeric)], numeric + 1
    for size in groups:
        hot = F.array_position(F.slice(features, start, size), F.lit(1.0)) - 1
        parts.append(F.array(hot.cast("double")))
        start += size
    return df.withColumn(features, F.concat(*parts))


def column_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each column, from one aggregate row."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def zscore(df: DataFrame, columns: Sequence[str], moments: dict | None = None, prefix: str = "z_") -> DataFrame:
    """Z-scores by the population standard deviation; a constant column is only centred."""
    moments = moments or column_moments(df, columns)
    scored = {}
    for c in columns:
        mean, std = moments[c]
        if mean is None:
            scored[f"{prefix}{c}"] = F.lit(None).cast("double")
        else:
            centred: Column = F.col(c) - F.lit(mean)
            scored[f"{prefix}{c}"] = centred / F.lit(std) if std and std > 0 else centred
    return df.withColumns(scored)


def zscore_vectors(df: DataFrame, features: str = "features", out: str = "scaled") -> DataFrame:
    """Z-scores of a vector column by population statistics; constant values are only centred (to 0).

    The scaler divides by the sample deviation; the factor sqrt(n / (n - 1)) turns it into the population one.
    """
    scaler = StandardScaler(inputCol=features, outputCol="_sample", withMean=True, withStd=True).fit(df)
    rows = df.count()
    factor = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
    stretch = ElementwiseProduct(
        inputCol="_sample", outputCol=out, scalingVec=Vectors.dense([factor] * len(scaler.mean))
    )
    return stretch.transform(scaler.transform(df)).drop("_sample")


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def array_vectors(df: DataFrame, column: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, as_vector(column))


