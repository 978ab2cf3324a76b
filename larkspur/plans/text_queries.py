"""Corpus shaping and feature queries."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.functions.hashing import split_name
from larkspur.functions.vectors import sparse_entries
from larkspur.operators import classify, corpus, features
from larkspur.plans import tables as t
from larkspur.plans.registry import query, r6, sql_bucket, sql_list, sql_r6
from larkspur.session import spread, stored_copy

TOP = sql_list(t.TOP)
STOP = sql_list(t.STOP_WORDS)


def _digests(df, tokens, *keep):
    return df.select(*keep, F.size(tokens).cast("bigint").alias("n"), tx.digest(tokens).alias("digest"))


# --- corpus shaping ---------------------------------------------------------------


@query(
    "label_one_vs_other",
    f"with {t.DOCS_SQL} select doc_id, case when list_contains(topics, 'src3') then 'src3' else 'other' end as category from docs",
)
def label_one_vs_other(spark, sf):
    return corpus.label_one_vs_other(t.docs(spark, sf), "src3", t.TOP).select("doc_id", "category")


@query(
    "label_top_category",
    f"""with {t.DOCS_SQL}
select doc_id, case when list_contains({TOP}, topics[1]) then topics[1] else topics[2] end as category
from docs where list_has_any(topics, {TOP})""",
)
def label_top_category(spark, sf):
    return corpus.label_top_category(t.docs(spark, sf), t.TOP).select("doc_id", "category")


@query(
    "parse_corpus",
    f"""with {t.DOCS_SQL}
select doc_id, case when list_contains({TOP}, topics[1]) then topics[1] else topics[2] end as category, md5(content || title) as digest
from docs where list_has_any(topics, {TOP})""",
)
def parse_corpus(spark, sf):
    rows = t.docs(spark, sf).withColumnRenamed("content", "body").drop("category")
    return corpus.parse_corpus(rows, t.TOP).select("doc_id", "category", F.md5("content").alias("digest"))


@query("filter_top_topics", f"with {t.DOCS_SQL} select doc_id, labels from docs where list_has_any(topics, {TOP})")
def filter_top_topics(spark, sf):
    return corpus.filter_top_topics(t.docs(spark, sf), t.TOP).select("doc_id", "labels")


@query("build_content", f"with {t.DOCS_SQL} select doc_id, md5(coalesce(nullif(content, title), '') || title) as digest from docs")
def build_content(spark, sf):
    rows = t.docs(spark, sf).withColumn("body", F.nullif("content", "title"))
    return corpus.build_content(rows).select("doc_id", F.md5("content").alias("digest"))


@query(
    "clean_text",
    """select doc_id, md5(replace(replace(text, chr(10), ' '), chr(3), '')) as spaced,
       md5(replace(replace(text, chr(10), ''), chr(3), '')) as removed from documents""",
)
def clean_text(spark, sf):
    rows = t.docs(spark, sf)
    return rows.select(
        "doc_id", F.md5(tx.clean_text("content")).alias("spaced"), F.md5(tx.clean_text("content", "")).alias("removed")
    )


@query("prefix_tags", "select doc_id, 'label:' || lang || ' label:' || source as tags from documents")
def prefix_tags(spark, sf):
    rows = corpus.prefix_tags(t.docs(spark, sf), "topics", "tags")
    return rows.select("doc_id", F.array_join("tags", " ").alias("tags"))


@query(
    "concat_columns",
    f"""with {t.DOCS_SQL}, w as (select doc_id, string_split(title || ' ' || array_to_string(topics, ' '), ' ') as w from docs)
select doc_id, len(w) as n, md5(array_to_string(w, '|')) as digest from w""",
)
def concat_columns(spark, sf):
    rows = features.concat_stage("title", "topics", "both").transform(t.docs(spark, sf))
    return _digests(rows, "both", "doc_id")


@query(
    "letters_only",
    """with e as (select unnest(regexp_split_to_array(text, '[ \\n]')) as token from documents)
select token, count(*) as n, regexp_full_match(token, '\\p{L}*') as letters from e group by 1""",
)
def letters_only(spark, sf):
    tokens = t.docs(spark, sf).select(F.explode(F.split("content", "[ \n]")).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n")).withColumn("letters", tx.letters_only("token"))


SPACE_WORDS = """list_reverse(list_reverse(w)[coalesce(list_position(list_transform(list_reverse(w), lambda x: x <> ''), true), len(w) + 1):])"""
WS_SQL = f"""raw as (select doc_id, lang as category, regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]') as w from documents),
words as (select doc_id, category, {SPACE_WORDS} as w from raw)"""


@query(
    "filter_terms",
    f"""with {WS_SQL}, kept as (
  select doc_id, list_filter(w, lambda x: length(x) > 2 and not list_contains({STOP}, x) and regexp_full_match(x, '\\p{{L}}*')) as w from words)
select doc_id, len(w) as n, md5(array_to_string(w, '|')) as digest from kept where len(w) > 1""",
)
def filter_terms(spark, sf):
    rows = t.docs(spark, sf).select("doc_id", tx.space_tokens("content").alias("words"))
    return _digests(corpus.filter_terms(rows, "words", t.STOP_WORDS), "words", "doc_id")


@query("bucket_sample", f"select doc_id, source from documents where {sql_bucket('doc_id', 100)} < 20")
def bucket_sample(spark, sf):
    return corpus.bucket_sample(t.table(spark, sf, "documents"), "doc_id", 20).select("doc_id", "source")


def _updates(spark, sf):
    """Customers in debt are cleared, suppliers arrive under new keys."""
    customer, supplier = t.table(spark, sf, "customer"), t.table(spark, sf, "supplier")
    cleared = customer.filter("c_acctbal < 0").select("c_custkey", "c_name", F.lit(0.0).alias("c_acctbal"))
    new = supplier.select((F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"))
    return corpus.union_parts(cleared, new)


@query(
    "upsert",
    """select c_custkey, c_name, case when c_acctbal < 0 then 0.0 else c_acctbal end as c_acctbal from customer
union all select s_suppkey + 1000000000, s_name, s_acctbal from supplier""",
)
def upsert(spark, sf):
    base = t.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return corpus.upsert(base, _updates(spark, sf), "c_custkey")


@query(
    "subtract_rows",
    """select l_partkey, l_returnflag from lineitem
where not exists (select 1 from part where p_partkey = l_partkey and p_type = 'PROMO') or l_returnflag <> 'R'""",
)
def subtract_rows(spark, sf):
    base = t.table(spark, sf, "lineitem").select("l_partkey", "l_returnflag")
    promo = t.table(spark, sf, "part").filter("p_type = 'PROMO'")
    removed = promo.select(F.col("p_partkey").alias("l_partkey"), F.lit("R").alias("l_returnflag"))
    return corpus.subtract_rows(base, removed)


@query(
    "binarize_ratings",
    f"""with {t.RATED_SQL} select "user", item, rating, case when rating - 2.5 > 0 then 1.0::double else 0.0 end as relevant from rated""",
)
def binarize_ratings(spark, sf):
    return corpus.binarize_ratings(t.rated(spark, sf))


@query(
    "clamp_scores",
    f"""with {t.RATED_SQL} select "user", item, least(greatest((rating - 3) / 2, 0.0), 1.0) as score from rated""",
)
def clamp_scores(spark, sf):
    rows = t.rated(spark, sf).select("user", "item", ((F.col("rating") - 3) / 2).alias("score"))
    return corpus.clamp(rows, "score")


# --- labels, tokens, n-grams ---------------------------------------------------------

INDEX_SQL = """idx as (
  select category, n, row_number() over (order by n desc, category) - 1 as i
  from (select lang as category, count(*) as n from documents group by 1))"""


@query("index_labels", f"with {INDEX_SQL} select category, i::double as category_index, n from idx")
def index_labels(spark, sf):
    rows = t.docs(spark, sf)
    indexed = features.index_labels(rows, "category", "category_index").transform(rows.select("category"))
    return indexed.groupBy("category", "category_index").agg(F.count("*").alias("n"))


@query(
    "unindex_labels",
    f"with {INDEX_SQL} select doc_id, i::double as category_index, category as restored from documents join idx on lang = category",
)
def unindex_labels(spark, sf):
    rows = t.docs(spark, sf).select("doc_id", "category")
    model = features.index_labels(rows, "category", "category_index")
    back = features.unindex_labels(model.transform(rows), model.labels, "category_index", "restored")
    return back.select("doc_id", "category_index", "restored")


@query("tokenize_ws", f"with {WS_SQL} select doc_id, len(w) as n, md5(array_to_string(w, '|')) as digest from words")
def tokenize_ws(spark, sf):
    rows = features.whitespace_words().transform(t.docs(spark, sf))
    return _digests(rows, "words", "doc_id")


def _regex_sql(column, length, lower):
    text = f"lower({column})" if lower else column
    return f"list_filter(regexp_extract_all({text}, '\\w+'), lambda x: length(x) >= {length})"


def _token_sql(column, length, lower):
    return f"""with {t.DOCS_SQL}, words as (select doc_id, {_regex_sql(column, length, lower)} as w from docs)
select doc_id, len(w) as n, md5(array_to_string(w, '|')) as digest from words"""


def _tokens(spark, sf, recipe):
    rows = features.regex_words(recipe.column, "words", recipe.min_length, recipe.lower).transform(t.docs(spark, sf))
    return _digests(rows, "words", "doc_id")


@query("tokenize_content", _token_sql("content", 3, False))
def tokenize_content(spark, sf):
    return _tokens(spark, sf, features.content_recipe())


@query("tokenize_title", _token_sql("title", 3, True))
def tokenize_title(spark, sf):
    return _tokens(spark, sf, features.title_recipe())


@query("tokenize_tags", _token_sql("labels", 2, True))
def tokenize_tags(spark, sf):
    return _tokens(spark, sf, features.tag_recipe())


TERMS_SQL = f"""{t.DOCS_SQL},
words as (
  select doc_id, category, list_filter({_regex_sql('content', 3, False)}, lambda x: not list_contains({STOP}, lower(x))) as w from docs),
grams as (
  select doc_id, category, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g from words),
counts as (select doc_id, term, count(*) as tf from (select doc_id, unnest(g) as term from grams) group by 1, 2),
vocabulary as (
  select term, sum(tf)::bigint as total, count(*) as docs_with from counts group by 1 having count(*) >= 3
  order by total desc, term limit 2000),
weights as (select doc_id, term, tf from counts join vocabulary using (term))"""


def _grams(spark, sf):
    """Content n-grams after stop-word removal, as the content pipeline makes them."""
    return t.docs(spark, sf).select(
        "doc_id", "category", tx.drop_words(tx.word_tokens("content", 3), t.STOP_WORDS).alias("w")
    ).select("doc_id", "category", tx.word_ngrams("w").alias("grams"))


@query("remove_stopwords", f"with {TERMS_SQL} select doc_id, len(w) as n, md5(array_to_string(w, '|')) as digest from words")
def remove_stopwords(spark, sf):
    words = features.regex_words("content", "words", 3, False).transform(t.docs(spark, sf))
    return _digests(features.stop_word_remover("words", "kept", t.STOP_WORDS).transform(words), "kept", "doc_id")


@query("word_ngrams", f"with {TERMS_SQL} select doc_id, len(g) as n, md5(array_to_string(g, '|')) as digest from grams")
def word_ngrams(spark, sf):
    return _digests(_grams(spark, sf), "grams", "doc_id")


# --- vocabulary and weights -------------------------------------------------------------


@query("build_vocabulary", f"with {TERMS_SQL} select term, total as tf, docs_with as df from vocabulary")
def build_vocabulary(spark, sf):
    return features.build_vocabulary(_grams(spark, sf), "grams", features.CONTENT_TERMS, features.CONTENT_MIN_DOCS)


def _stored_grams(spark, sf):
    """The same from words that are tokenised and stored once, however many passes read them."""
    words = t.docs(spark, sf).select("doc_id", "category", tx.drop_words(tx.word_tokens("content", 3), t.STOP_WORDS).alias("w"))
    return stored_copy(words).select("doc_id", "category", tx.word_ngrams("w").alias("grams"))


def _terms(rows):
    return features.term_table(rows, "grams", features.CONTENT_TERMS, features.CONTENT_MIN_DOCS)


def _weights(rows, *stages):
    """(doc_id, term, weight) of stages made from the term table, the last of which makes ``weights``."""
    table = _terms(rows)
    made = PipelineModel([features.count_vectorizer(table.terms, "grams", "tf"), *(stage(table) for stage in stages)]).transform(rows)
    entries = features.with_terms(sparse_entries(made, "weights", "doc_id"), table.terms)
    return entries.select("doc_id", "term", r6("value").alias("weight"))


@query("term_counts", f"with {TERMS_SQL} select doc_id, term, tf::double as tf from weights")
def term_counts(spark, sf):
    rows = _stored_grams(spark, sf)
    return features.term_counts(rows, "doc_id", "grams", _terms(rows).terms)


def content_words(spark, sf):
    """(doc_id, w): the words of the content without stop words, of the documents."""
    words = t.docs(spark, sf).select("doc_id", tx.drop_words(tx.word_tokens("content", 3), t.STOP_WORDS).alias("w"))
    return stored_copy(words)


IDF_SQL = f"""{TERMS_SQL},
size as (select count(*) as n from docs),
idf as (select term, case when docs_with >= 3 then ln((n + 1.0) / (docs_with + 1.0)) else 0 end as idf from vocabulary, size),
tfidf as (select doc_id, term, tf * idf as weight from weights join idf using (term))"""


@query("tf_idf", f"with {IDF_SQL} select doc_id, term, {sql_r6('weight')} as weight from tfidf")
def tf_idf(spark, sf):
    return _weights(_stored_grams(spark, sf), lambda table: features.weighted(table.idf(), "tf", "weights"))


@query(
    "l1_normalize",
    f"""with {TERMS_SQL}
select doc_id, term, {sql_r6('tf / sum(tf) over (partition by doc_id)')} as weight from weights""",
)
def l1_normalize(spark, sf):
    return _weights(_stored_grams(spark, sf), lambda table: features.l1_normalizer("tf", "weights"))


@query(
    "std_scale",
    f"""with {TERMS_SQL},
sds as (
  select term, sqrt((sum(tf * tf) - sum(tf) * sum(tf) / (select count(*) from docs)) / ((select count(*) from docs) - 1)) as sd
  from weights group by 1)
select doc_id, term, {sql_r6('case when sd > 0 then tf / sd else 0 end')} as weight from weights join sds using (term)""",
)
def std_scale(spark, sf):
    return _weights(_stored_grams(spark, sf), lambda table: features.weighted(table.per_deviation(), "tf", "weights"))


@query(
    "train_only_tfidf",
    f"""with {TERMS_SQL},
parts as (select doc_id, case when {sql_bucket('doc_id', 100)} < 90 then 'train' else 'test' end as part from docs),
size as (select count(*) as n from parts where part = 'train'),
dfs as (select term, count(*) filter (part = 'train') as d from weights join parts using (doc_id) group by 1),
idf as (select term, case when d >= 3 then ln((n + 1.0) / (d + 1.0)) else 0 end as idf from dfs, size),
w as (select part, doc_id, term, tf * idf as x from weights join idf using (term) join parts using (doc_id)),
s as (select part, doc_id, term, x, sum(abs(x)) over (partition by doc_id) as total from w)
select part, doc_id, term, {sql_r6('case when total > 0 then x / total else 0 end')} as weight from s""",
)
def train_only_tfidf(spark, sf):
    rows = _stored_grams(spark, sf)
    vocabulary = _terms(rows).terms
    train, test = classify.hash_split(rows, "doc_id", {"train": 90, "test": 10})
    out = []
    for name, part in zip(("train", "test"), features.tf_idf(train, [test], "grams", vocabulary, "weights")):
        entries = features.with_terms(sparse_entries(part, "weights", "doc_id"), vocabulary)
        out.append(entries.select(F.lit(name).alias("part"), "doc_id", "term", r6("value").alias("weight")))
    return corpus.union_parts(*out)


# --- pipelines ------------------------------------------------------------------------------


def _pipeline_entries(spark, sf, recipe):
    rows = t.docs(spark, sf)
    model = features.fit_text(rows, recipe)
    out = features.feature_columns(rows, model, [recipe])
    return sparse_entries(out, recipe.out, "doc_id").select("doc_id", "index", r6("value").alias("value"))


def entries_sql(recipe):
    """The steps to (doc_id, index, value): counts over the recipe's vocabulary, divided by their deviation."""
    name, two = recipe.out, recipe.n > 1
    words = _regex_sql(recipe.column, recipe.min_length, recipe.lower)
    words = f"list_filter({words}, lambda x: not list_contains({STOP}, lower(x)))" if two else words
    terms = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))" if two else "w"
    return f"""{name}_words as (select doc_id, {words} as w from docs),
{name}_counts as (select doc_id, term, count(*) as tf from (select doc_id, unnest({terms}) as term from {name}_words) group by 1, 2),
{name}_sums as (
  select term, sum(tf) as total, greatest(0, sum(tf * tf) - sum(tf) * sum(tf) / (select count(*) from docs)) as squares
  from {name}_counts group by 1 having count(*) >= {recipe.min_docs}),
{name}_vocabulary as (
  select term, row_number() over (order by total desc, term) - 1 as place, sqrt(squares / ((select count(*) from docs) - 1)) as sd
  from {name}_sums qualify place < {recipe.size}),
{name} as (
  select doc_id, place::int as index, case when sd > 0 then tf / sd else 0 end as value
  from {name}_counts join {name}_vocabulary using (term))"""


def features_sql(recipe):
    return f"with {t.DOCS_SQL}, {entries_sql(recipe)} select doc_id, index, {sql_r6('value')} as value from {recipe.out}"


def _fused_sql(*recipes):
    width = " + ".join(f"(select count(*) from {r.out}_vocabulary)" for r in recipes)
    parts = " union all ".join(f"select doc_id, value from {r.out}" for r in recipes)
    return f"""with {t.DOCS_SQL}, {INDEX_SQL}, {", ".join(map(entries_sql, recipes))},
sums as (select doc_id, count(*) filter (value <> 0) as entries, sum(value) as total from ({parts}) group by 1)
select doc_id, category, i::double as "{features.LABEL}", ({width})::int as width, coalesce(entries, 0)::int as entries,
       {sql_r6('coalesce(total, 0)')} as total
from docs join idx using (category) left join sums using (doc_id)"""


@query("content_features", features_sql(features.content_recipe()))
def content_features(spark, sf):
    return _pipeline_entries(spark, sf, features.content_recipe(t.STOP_WORDS))


@query("title_features", features_sql(features.title_recipe()))
def title_features(spark, sf):
    return _pipeline_entries(spark, sf, features.title_recipe(t.STOP_WORDS))


@query("tag_features", features_sql(features.tag_recipe()))
def tag_features(spark, sf):
    return _pipeline_entries(spark, sf, features.tag_recipe())


def _fused(stored, column):
    values = vector_to_array(column)
    return stored.withColumn("v", values).select(
        "doc_id",
        "category",
        features.LABEL,
        F.size("v").alias("width"),
        F.size(F.filter("v", lambda x: x != 0)).alias("entries"),
        r6(F.aggregate("v", F.lit(0.0), lambda s, x: s + x)).alias("total"),
    )


@query("fused_features", _fused_sql(features.content_recipe(), features.title_recipe()))
def fused_features(spark, sf):
    return _fused(t.feature_set(spark, sf), features.FEATURES)


@query("three_way_features", _fused_sql(features.content_recipe(), features.title_recipe(), features.tag_recipe()))
def three_way_features(spark, sf):
    parts = VectorAssembler(inputCols=[features.FEATURES, features.tag_recipe().out], outputCol="all_features")
    return _fused(parts.transform(t.feature_set(spark, sf)), "all_features")


@query(
    "extract_words",
    f"""with {WS_SQL}, {INDEX_SQL}, kept as (select doc_id, category, list_filter(w, lambda x: not list_contains({STOP}, x)) as w from words)
select doc_id, i::double as category_index, len(w) as n, md5(array_to_string(w, '|')) as digest from kept join idx using (category)""",
)
def extract_words(spark, sf):
    rows = features.extract_words(t.docs(spark, sf), t.STOP_WORDS)
    return _digests(rows, "filteredWords", "doc_id", F.col(features.LABEL).alias("category_index"))


@query("label_distribution", "select lang as category, count(*) as n from documents group by 1")
def label_distribution(spark, sf):
    return features.label_distribution(t.docs(spark, sf))


# --- numeric features ---------------------------------------------------------------------------


@query(
    "one_hot",
    """with a as (select v, row_number() over (order by v) - 1 as i, count(*) over () as n from (select distinct l_linestatus as v from lineitem)),
b as (select v, row_number() over (order by v) - 1 as i, count(*) over () as n from (select distinct o_orderpriority as v from lineitem join orders on l_orderkey = o_orderkey)),
c as (select v, row_number() over (order by v) - 1 as i, count(*) over () as n from (select distinct p_type as v from lineitem join part on l_partkey = p_partkey))
select l_orderkey, l_linenumber, l_quantity as first_value, l_extendedprice as value_after,
       (4 + a.n + b.n + c.n)::int as size, (1 + a.i)::int as hot_1, (1 + a.n + b.i)::int as hot_2, (1 + a.n + b.n + c.i)::int as hot_3
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
join a on l_linestatus = a.v join b on o_orderpriority = b.v join c on p_type = c.v""",
)
def one_hot(spark, sf):
    rows = t.measurement_rows(spark, sf)
    numeric = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    hot = features.one_hot(rows, numeric, ["l_linestatus", "o_orderpriority", "p_type"])
    laid = hot.withColumn("v", vector_to_array("features"))
    tail = F.slice("v", F.lit(2), F.size("v") - len(numeric))
    ones = F.filter(F.transform(tail, lambda x, i: F.when(x == 1.0, i + 1)), lambda i: i.isNotNull())
    laid = laid.withColumn("ones", ones)
    return laid.select(
        "l_orderkey", "l_linenumber", F.col("v")[0].alias("first_value"),
        F.element_at("v", -(len(numeric) - 1)).alias("value_after"), F.size("v").alias("size"),
        *[F.get("ones", F.lit(i)).alias(f"hot_{i + 1}") for i in range(3)],
    )


def cover_rows(spark, sf):
    """Rows of ten numbers, a 4-way and a 40-way one-hot group and a class 1..7, as text lines parsed back."""
    from larkspur.sources import lines

    rows = t.order_lines(spark, sf)

    def hot(at, size):
        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(i == at, "1").otherwise("0"))

    ones = [hot(F.col("l_linenumber") % 4, 4), hot(F.col("l_suppkey") % 40, 40)]
    label = 1 + F.least(F.lit(6), F.floor(F.col("l_extendedprice") / 16000))
    line = F.concat_ws(
        ",", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey",
        "p_size", "p_retailprice", *ones, label,
    )
    parsed = lines.parse_class_csv(rows.select("l_orderkey", "l_linenumber", line.alias("value")))
    return features.un_one_hot(parsed)


@query(
    "un_one_hot",
    f"""select l_orderkey, l_linenumber, {sql_r6('l_quantity')} as first_value, {sql_r6('p_retailprice')} as tenth_value, 12::int as size,
       (l_linenumber % 4)::double as group_1, (l_suppkey % 40)::double as group_2,
       least(6, floor(l_extendedprice / 16000))::double as label
from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey""",
)
def un_one_hot(spark, sf):
    rows = cover_rows(spark, sf)
    at = F.col("features")
    return rows.select(
        "l_orderkey", "l_linenumber", r6(at[0]).alias("first_value"), r6(at[9]).alias("tenth_value"), F.size(at).alias("size"),
        at[10].alias("group_1"), at[11].alias("group_2"), "label",
    )


Z_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "constant"]


@query(
    "zscore",
    "with m as (select avg(l_quantity) as m1, stddev_pop(l_quantity) as s1, avg(l_extendedprice) as m2, stddev_pop(l_extendedprice) as s2, "
    "avg(l_discount) as m3, stddev_pop(l_discount) as s3, avg(l_tax) as m4, stddev_pop(l_tax) as s4 from lineitem) "
    f"select l_orderkey, l_linenumber, {sql_r6('(l_quantity - m1) / s1')} as z_l_quantity, {sql_r6('(l_extendedprice - m2) / s2')} as z_l_extendedprice, "
    f"{sql_r6('(l_discount - m3) / s3')} as z_l_discount, {sql_r6('(l_tax - m4) / s4')} as z_l_tax, 0.0::double as z_constant from lineitem, m",
)
def zscore(spark, sf):
    rows = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *Z_COLUMNS[:4])
    rows = spread(rows).withColumn("constant", F.lit(3.0))
    scored = features.zscore(rows, Z_COLUMNS)
    return scored.select("l_orderkey", "l_linenumber", *[r6(f"z_{c}").alias(f"z_{c}") for c in Z_COLUMNS])


@query(
    "hash_split",
    f"""select o_orderkey, case when b < 80 then 'train' when b < 90 then 'valid' else 'test' end as part
from (select o_orderkey, {sql_bucket('o_orderkey', 100)} as b from orders)""",
)
def hash_split(spark, sf):
    shares = {"train": 80, "valid": 10, "test": 10}
    return t.table(spark, sf, "orders").select("o_orderkey", split_name(F.col("o_orderkey"), shares).alias("part"))


@query("kfold_assign", f"""select doc_id, {sql_bucket("('10:' || doc_id)", 10)}::int as fold from documents""")
def kfold_assign(spark, sf):
    return classify.with_fold(t.table(spark, sf, "documents"), "doc_id").select("doc_id", "fold")
