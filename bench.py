"""Time the headline queries and print one JSON line.

Input folder: $BENCH_SF_DIR (default /root/testdata/sf0.1); cores: $BENCH_CPUS.
Every query is run to completion into Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import time

from larkspur.plans.catalog import QUERIES
from larkspur.session import local_session

HEADLINE = [
    # text
    "build_vocabulary", "filter_terms", "word_ngrams", "tf_idf", "std_scale", "train_only_tfidf", "fused_features",
    # numeric features and corpus shaping
    "parse_labeled_csv", "one_hot", "un_one_hot", "zscore", "upsert", "subtract_rows", "clean_json_corpus",
    "upsert_stored", "export_by_category", "stop_words_from_file",
    # recommendation
    "canonical_ratings", "popularity_scores", "negative_samples", "mean_user_auc", "genre_ranked_list", "ndcg_at_k",
    "als_explicit", "recommend_all_users",
    # clustering, evaluation, similarity
    "nearest_centroid", "weighted_cluster_entropy", "distance_anomalies", "weighted_metrics", "roc_points",
    "cosine_pairs", "cosine_topk", "transpose", "kmeans_fit", "kmeans_sweep_scaled",
    # classification
    "decision_tree", "naive_bayes", "ovr_logistic_grid", "kfold_scores", "ovr_bayes_grid", "cv_pipeline",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{sf}/nation.parquet").count()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
