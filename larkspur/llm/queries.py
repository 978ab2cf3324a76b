"""The operators bound to the tables, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import dac, debruijn, forest, gnat, hmm, jaccard, licences, packing, pieces, quality, suffix, topk, whiten
from larkspur.llm.tables import documents

BYTE_TOKENIZER, WORD_TOKENIZER, PIECE_MODEL = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.remove_strings(documents(spark, folder))


def op2_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(documents(spark, folder), tokenizer_path(PIECE_MODEL))


def op4_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(documents(spark, folder))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return debruijn.remove_passages(documents(spark, folder))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), tokenizer_path(WORD_TOKENIZER))


def op8_hmm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.score_documents(documents(spark, folder))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join_documents(documents(spark, folder))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return dac.token_files(documents(spark, folder), tokenizer_path(BYTE_TOKENIZER))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return gnat.hard_negatives(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op12_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return forest.near_copies(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))


OPERATORS = [
    op1_suffix_dedup, op2_exact_topk, op3_sentencepiece, op4_licence_scan, op5_substring_dedup,
    op6_quality_rules, op7_packing, op8_hmm_scoring, op9_jaccard_join, op10_token_files,
    op11_hard_negatives, op12_embedding_dedup, op13_whitening,
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPERATORS}

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: op1 takes DuckDB minutes on 2 MB, so it has no SQL; it and the operators beyond SQL are tested against brute force.
ORACLES: dict[str, str] = {
    "op2_exact_topk": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) n from s)
select query_id, n::int rank, vec_id, score from r where n <= 5
""",
    "op4_licence_scan": licences.sql(),
    "op5_substring_dedup": f"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') w from documents where doc_id is not null),
words as (select doc_id, w, unnest(range(1, len(w) + 1)) i from docs),
windows as (select doc_id, i, row_number() over (partition by array_to_string(w[i:i + 19], ' ') order by doc_id, i) > 1 again from words where i + 19 <= len(w)),
marked as (select doc_id, i, w[i] word, count(*) filter (again) over (partition by doc_id order by i rows between 19 preceding and current row) > 0 gone
  from words left join windows using (doc_id, i)),
sums as (select doc_id, count(*) filter (gone) r, string_agg(word, ' ' order by i) filter (not gone) k from marked group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(r, 0)::bigint n_removed, sha256(coalesce(k, '')) kept_sha256 from docs left join sums using (doc_id)
""",
    "op9_jaccard_join": f"""
with recursive docs as (select doc_id, regexp_extract_all({LOWER}, '{WORD}') w from documents where doc_id is not null),
shingles as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) s from docs),
sizes as (select doc_id, count(*) n from shingles group by doc_id),
pairs as (select a.doc_id x, b.doc_id y, count(*) c from shingles a join shingles b using (s) where a.doc_id <> b.doc_id group by all),
links as (select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
reach(doc_id, other) as (select doc_id, doc_id from docs union select r.doc_id, l.y from reach r join links l on l.x = r.other)
select doc_id, coalesce(any_value(n), 0)::bigint n_shingles, min(other)::bigint component_id from reach left join sizes using (doc_id) group by doc_id
""",
    "op11_hard_negatives": """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l, list_transform(embedding, lambda x: floor(256 * x::double)) e from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id anchor_id, a.l = c.l same, c.vec_id, list_inner_product(a.e, c.e)::bigint score from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id positive_id, score positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (select p.*, vec_id negative_id, score negative_score, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) r
  from p join s using (anchor_id) where not same and 80 * positive_score <= 100 * score and score <= positive_score)
select anchor_id, positive_id, r::int rank, negative_id, positive_score, negative_score from n where r <= 5
""",
    "op12_embedding_dedup": """
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) e from embeddings where vec_id is not null
  and label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id x, b.vec_id y from v a join v b using (label) where a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.93),
reach(vec_id, other) as (select vec_id, vec_id from embeddings where vec_id is not null union select r.vec_id, l.y from reach r join links l on l.x = r.other),
least as (select vec_id, min(other) component_id from reach group by vec_id),
counts as (select x vec_id, count(*) n from links group by x)
select vec_id, coalesce(n, 0)::bigint n_links, component_id::bigint component_id, vec_id = component_id kept from least left join counts using (vec_id)
""",
}
