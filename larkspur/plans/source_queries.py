"""Sources and sinks: lines are made from table columns and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.text import digest, word_tokens
from larkspur.functions.vectors import sparse_entries
from larkspur.operators import corpus, features
from larkspur.plans import tables as t
from larkspur.plans.registry import query, r6, sql_list, sql_r6
from larkspur.plans.text_queries import TERMS_SQL, entries_sql, features_sql
from larkspur.session import scratch_path, spread
from larkspur.sources import documents, lines, stores


@query(
    "parse_labeled_csv",
    f"""select l_returnflag as label, {sql_r6('l_quantity')} as f0, {sql_r6('l_extendedprice')} as f1,
       {sql_r6('l_discount')} as f2, {sql_r6('l_tax')} as f3
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
)
def parse_labeled_csv(spark, sf):
    rows = t.order_lines(spark, sf)
    line = F.concat_ws(
        ",", "l_quantity", "l_linestatus", "o_orderpriority", "p_type", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    parsed = lines.parse_labeled_csv(rows.select(line.alias("value")))
    return parsed.select("label", *[r6(F.col("features")[i]).alias(f"f{i}") for i in range(4)])


@query(
    "parse_class_csv",
    f"""select l_linenumber - 1.0::double as label, {sql_r6('l_quantity')} as f0, {sql_r6('l_extendedprice')} as f1,
       {sql_r6('l_discount')} as f2, {sql_r6('l_tax')} as f3 from lineitem""",
)
def parse_class_csv(spark, sf):
    line = F.concat_ws(",", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    parsed = lines.parse_class_csv(spread(t.table(spark, sf, "lineitem").select(line.alias("value"))))
    return parsed.select("label", *[r6(F.col("features")[i]).alias(f"f{i}") for i in range(4)])


@query("parse_play_counts", f"""with {t.PLAYS_SQL} select "user"::int as "user", item::int as item, rating from plays""")
def parse_play_counts(spark, sf):
    line = F.concat_ws(" ", "user", "item", F.col("rating").cast("bigint"))
    return lines.parse_play_counts(t.plays(spark, sf).select(line.alias("value")))


def _name_lines(spark, sf):
    """Names as tab-separated lines; three part types are written in a malformed way."""
    kind, key = F.col("p_type"), F.col("p_partkey")
    line = (
        F.when(kind == "PROMO", F.concat_ws(" ", key, F.col("p_name")))
        .when(kind == "SMALL", F.concat(key.cast("string"), F.lit("\t")))
        .when(kind == "LARGE", F.concat(F.lit("x"), key, F.lit("\t"), F.col("p_name")))
        .otherwise(F.concat(key.cast("string"), F.lit("\t"), F.col("p_name"), F.lit(" ")))
    )
    return t.table(spark, sf, "part").select(line.alias("value"))


@query(
    "parse_id_names",
    "select p_partkey::int as id, p_name as name from part where p_type not in ('PROMO', 'SMALL', 'LARGE')",
)
def parse_id_names(spark, sf):
    return lines.parse_id_names(_name_lines(spark, sf))


@query(
    "count_malformed_names",
    """select count(*) filter (p_type not in ('PROMO', 'SMALL', 'LARGE')) as kept,
       count(*) filter (p_type in ('PROMO', 'SMALL', 'LARGE')) as malformed from part""",
)
def count_malformed_names(spark, sf):
    return lines.count_malformed_names(_name_lines(spark, sf))


def alias_lines(spark, sf):
    """Two alias lines per part: its number, then, later, the smallest number with its name."""
    part = t.table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    first = part.groupBy("p_name").agg(F.min("p_partkey").alias("good"))
    both = part.join(first, "p_name")
    bad = F.when(F.col("p_type") == "SMALL", F.lit("")).otherwise(F.col("p_partkey").cast("string"))
    entries = F.array(
        F.struct((2 * F.col("p_partkey")).alias("line_no"), F.concat_ws("\t", F.col("p_partkey"), F.col("p_partkey")).alias("value")),
        F.struct((2 * F.col("p_partkey") + 1).alias("line_no"), F.concat_ws("\t", bad, F.col("good")).alias("value")),
    )
    return both.select(F.explode(entries).alias("e")).select("e.*")


ALIAS_SQL = """firsts as (select p_name, min(p_partkey) as good from part group by 1),
alias_rows as (
  select 2 * p_partkey as line_no, p_partkey as bad_id, p_partkey as good_id from part
  union all
  select 2 * p_partkey + 1, case when p_type = 'SMALL' then 0 else p_partkey end,
         case when p_type = 'SMALL' then 0 else good end
  from part join firsts using (p_name)),
alias as (
  select bad_id, good_id from alias_rows
  qualify row_number() over (partition by bad_id order by line_no desc) = 1)"""


@query("parse_alias", f"with {ALIAS_SQL} select bad_id::int as bad_id, good_id::int as good_id from alias")
def parse_alias(spark, sf):
    return lines.parse_alias(alias_lines(spark, sf))


@query(
    "parse_ratings",
    f"""with {t.RATED_SQL}
select 'colons' as form, "user"::int as "user", item::int as item, rating::double as rating from rated
union all select 'comma', "user"::int, item::int, rating::double from rated""",
)
def parse_ratings(spark, sf):
    rows = t.rated(spark, sf)
    colons = lines.parse_ratings(rows.select(F.concat_ws("::", *rows.columns).alias("value")))
    comma = lines.parse_ratings(rows.select(F.concat_ws(",", *rows.columns).alias("value")), ",")
    return colons.select(F.lit("colons").alias("form"), "*").unionByName(comma.select(F.lit("comma").alias("form"), "*"))


@query(
    "parse_items",
    "select p_partkey::int as id, p_name as title, p_type || '/' || p_brand as genres, 2::int as n_genres from part",
)
def parse_items(spark, sf):
    rows = t.items(spark, sf)
    line = F.concat_ws("::", "id", "title", F.array_join("genres", "|"))
    parsed = lines.parse_items(rows.select(line.alias("value")))
    return parsed.select("id", "title", F.array_join("genres", "/").alias("genres"), F.size("genres").alias("n_genres"))


def _news(spark, sf):
    """Documents in the shape of news items: the first line as title, English text without title."""
    return t.docs(spark, sf).select(
        F.when(F.col("category") != "en", F.col("title")).alias("title"),
        F.when(F.col("category") != "es", F.col("content")).alias("body"),
        F.lit("1987").alias("date"),
        F.col("topics"),
        F.array(F.col("category")).alias("places"),
        F.array().cast("array<string>").alias("organisations"),
        F.col("doc_id").cast("int").alias("id"),
    )


@query(
    "read_json_docs",
    f"""with {t.DOCS_SQL}
select doc_id::int as id, md5(case when category <> 'en' then title end) as title, md5(case when category <> 'es' then content end) as body,
       '1987' as date, array_to_string(topics, '|') as topics, category as places, 0::int as n_organisations from docs""",
)
def read_json_docs(spark, sf):
    path = scratch_path(spark, "news")
    documents.write_json_lines(_news(spark, sf), path)
    read = documents.read_news(spark, path)
    return read.select(
        "id",
        F.md5("title").alias("title"),
        F.md5("body").alias("body"),
        "date",
        F.array_join("topics", "|").alias("topics"),
        F.array_join("places", "|").alias("places"),
        F.size("organisations").alias("n_organisations"),
    )


@query(
    "clean_json_corpus",
    f"""with {t.DOCS_SQL}
select doc_id::int as id, md5(replace(replace(content, chr(10), ''), chr(3), '')) as body, array_to_string(topics, '|') as topics
from docs where category <> 'es' and list_has_any(topics, {sql_list(t.TOP)})""",
)
def clean_json_corpus(spark, sf):
    arrays, path = scratch_path(spark, "news-arrays"), scratch_path(spark, "clean-news")
    documents.write_news_arrays(_news(spark, sf), arrays)
    documents.write_json_lines(documents.clean_news(documents.read_news_arrays(spark, arrays), t.TOP), path)
    kept = documents.read_news(spark, path)
    return kept.select("id", F.md5("body").alias("body"), F.array_join("topics", "|").alias("topics"))


@query(
    "stop_words_from_file",
    f"""with {TERMS_SQL} select f.form, doc_id, len(w) as n, md5(array_to_string(w, '|')) as digest
from words cross join (values ('literal'), ('joined')) f(form)""",
)
def stop_words_from_file(spark, sf):
    """A stored list of stop words, once short enough for a literal, once taken as too long for one."""
    path = scratch_path(spark, "stop-words")
    spark.createDataFrame([(w,) for w in t.STOP_WORDS], "value string").write.text(path)
    words = documents.stop_word_table(spark, path)
    rows = t.docs(spark, sf).select("doc_id", word_tokens("content", 3).alias("w"))
    parts = []
    for form, most in (("literal", corpus.LITERAL_WORDS), ("joined", 10)):
        kept = corpus.remove_words(rows, "doc_id", "w", words, most)
        parts.append(kept.select(F.lit(form).alias("form"), "doc_id", F.size("w").cast("bigint").alias("n"), digest("w").alias("digest")))
    return corpus.union_parts(*parts)


@query(
    "upsert_stored",
    """with old as (select c_custkey as k, c_name as name, c_acctbal as amount, 1 as version from customer
  union all select c_custkey, c_name, c_acctbal + 1, 2 from customer where c_nationkey < 5),
new as (select c_custkey as k, c_name as name, 0.0 as amount, 3 as version from customer where c_custkey % 97 = 0
  union all select c_custkey, c_name, -1.0, 4 from customer where c_custkey % 194 = 0
  union all select s_suppkey + 1000000000, s_name, s_acctbal, 3 from supplier where s_suppkey <= 10),
ranked as (select *, row_number() over (partition by k order by version desc) as r from (select * from old union all select * from new))
select k, name, amount, version from ranked where r = 1""",
)
def upsert_stored(spark, sf):
    """Keys repeat on both sides; the update rewrites the folders it touches, and no others."""
    customer, supplier, path = t.table(spark, sf, "customer"), t.table(spark, sf, "supplier"), scratch_path(spark, "keyed")

    def rows(df, key, name, amount, version):
        return df.select(F.col(key).alias("k"), F.col(name).alias("name"), amount.alias("amount"), F.lit(version).alias("version"))

    balance = F.col("c_acctbal")
    old = corpus.union_parts(
        rows(customer, "c_custkey", "c_name", balance, 1), rows(customer.where("c_nationkey < 5"), "c_custkey", "c_name", balance + 1, 2)
    )
    arrived = supplier.where("s_suppkey <= 10").withColumn("s_suppkey", F.col("s_suppkey") + 1_000_000_000)
    new = corpus.union_parts(
        rows(customer.where("c_custkey % 97 = 0"), "c_custkey", "c_name", F.lit(0.0), 3),
        rows(customer.where("c_custkey % 194 = 0"), "c_custkey", "c_name", F.lit(-1.0), 4),
        rows(arrived, "s_suppkey", "s_name", F.col("s_acctbal"), 3),
    )
    stores.write_keyed(old, path, "k", "version")
    stores.update_keyed(spark, path, new, "k", "version")
    return stores.read_keyed(spark, path)


@query(
    "export_by_category",
    f"""with {t.DOCS_SQL}, {entries_sql(features.tag_recipe())},
sums as (select doc_id, sum(value) as s from {features.tag_recipe().out} group by 1),
kinds as (select distinct category as kind from docs)
select kind as category, count(*) as n, count(*) filter (category = kind) as positive, {sql_r6('sum(coalesce(s, 0))')} as total,
       {sql_r6('sum(case when category = kind then coalesce(s, 0) else 0 end)')} as positive_total
from docs left join sums using (doc_id) cross join kinds group by 1""",
)
def export_by_category(spark, sf):
    """One folder for each language, its documents against all others, read back by folder."""
    path, recipe, rows = scratch_path(spark, "by-category"), features.tag_recipe(), t.docs(spark, sf)
    model = features.fit_text(rows, recipe)
    kinds = features.index_labels(rows).labels
    made = model.transform(rows).select("doc_id", "category", recipe.out)
    stores.export_by_category(made, path, len(model.stages[-2].vocabulary), kinds, features=recipe.out)
    read = stores.read_by_category(spark, path)
    total = F.aggregate("entries", F.lit(0.0), lambda s, e: s + e["value"])
    summed = read.select("category", "label", total.alias("s"))
    return summed.groupBy("category").agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("positive"), r6(F.sum("s")).alias("total"),
        r6(F.sum(F.col("s") * F.col("label"))).alias("positive_total"),
    )


@query(
    "docs_with_defaults",
    f"""with {t.DOCS_SQL}
select doc_id, coalesce(nullif(category, 'en'), 'other') as category, md5(coalesce(nullif(content, title), 'other')) as content,
       coalesce(case when category = 'fr' then null else title end, 'other') as title,
       coalesce(case when category = 'de' then null else labels end, 'empty') as labels from docs""",
)
def docs_with_defaults(spark, sf):
    rows = t.docs(spark, sf).select(
        "doc_id",
        F.nullif("category", F.lit("en")).alias("category"),
        F.nullif("content", "title").alias("content"),
        F.when(F.col("category") != "fr", F.col("title")).alias("title"),
        F.when(F.col("category") != "de", F.col("labels")).alias("labels"),
    )
    return documents.with_defaults(rows).withColumn("content", F.md5("content"))


@query(
    "article_content",
    f"with {t.DOCS_SQL} select doc_id::varchar as id, category, md5(content || chr(10) || title) as content, labels from docs",
)
def article_content(spark, sf):
    rows = t.docs(spark, sf).select(
        F.col("doc_id").cast("string").alias("id"), "content", "title", F.lit("").alias("date"), "category",
        F.split("labels", " ").alias("labels"),
    )
    read = documents.parse_articles(rows.select(F.to_json(F.struct(*rows.columns)).alias("value")))
    return read.select("id", "category", F.md5("content").alias("content"), F.array_join("labels", " ").alias("labels"))


@query(
    "parse_vectors",
    f"""select vec_id, i as position, {sql_r6('x')} as value from (
  select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1)::int - 1 as i from embeddings)""",
)
def parse_vectors(spark, sf):
    line = F.array_join(F.transform("features", lambda x: x.cast("string")), " ")
    parsed = lines.parse_vectors(t.vectors(spark, sf).select("vec_id", line.alias("value")))
    return parsed.select("vec_id", F.posexplode("features").alias("position", "v")).select("vec_id", "position", r6("v").alias("value"))


@query("xml_pages", "select page_id, length(html)::int as n_chars, md5(html) as digest from pages")
def xml_pages(spark, sf):
    path = scratch_path(spark, "xml")
    pages = t.table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text"))
    documents.write_xml_pages(pages, path)
    read = documents.read_xml_pages(spark, path, "id bigint, text string")
    return read.select(F.col("id").alias("page_id"), F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


@query("feature_store_roundtrip", features_sql(features.tag_recipe()))
def feature_store_roundtrip(spark, sf):
    path = scratch_path(spark, "features")
    rows = t.docs(spark, sf)
    recipe = features.tag_recipe()

    def build():
        return features.fit_text(rows, recipe).transform(rows).select("doc_id", recipe.out)

    stores.load_or_build(spark, path, build)
    stored = stores.load_or_build(spark, path, lambda: (_ for _ in ()).throw(RuntimeError("must not be built again")))
    return sparse_entries(stored, recipe.out, "doc_id").select("doc_id", "index", r6("value").alias("value"))


@query(
    "docfreq_sink",
    """with e as (select doc_id, unnest(list_filter(regexp_extract_all(text, '\\w+'), lambda t: length(t) >= 3)) as term from documents)
select term, count(distinct doc_id) as df from e group by 1""",
)
def docfreq_sink(spark, sf):
    path = scratch_path(spark, "docfreqs")
    rows = t.docs(spark, sf).select(word_tokens("content", 3).alias("words"))
    stores.write_doc_freqs(features.document_frequencies(rows, "words"), path)
    return stores.read_doc_freqs(spark, path)


@query(
    "export_labeled_vectors",
    f"""select label::double as label, count(*) as n, {sql_r6('sum(s)')} as total
from (select label, list_sum(embedding::double[]) as s from embeddings) group by 1""",
)
def export_labeled_vectors(spark, sf):
    path = scratch_path(spark, "vectors")
    stores.export_labeled_vectors(t.ml_vectors(spark, sf), path)
    read = stores.read_labeled_vectors(spark, path, 64)
    summed = read.select("label", F.unwrap_udt("features").alias("v")).select(
        "label", F.aggregate("v.values", F.lit(0.0), lambda s, x: s + x).alias("s")
    )
    return summed.groupBy("label").agg(F.count("*").alias("n"), r6(F.sum("s")).alias("total"))


@query("model_roundtrip", features_sql(features.title_recipe()))
def model_roundtrip(spark, sf):
    rows = t.docs(spark, sf)
    recipe = features.title_recipe(t.STOP_WORDS)
    model = features.fit_text(rows, recipe)
    path = scratch_path(spark, "model")
    stores.save_model(model, path)
    loaded = stores.load_model(path)
    return sparse_entries(loaded.transform(rows), recipe.out, "doc_id").select("doc_id", "index", r6("value").alias("value"))


