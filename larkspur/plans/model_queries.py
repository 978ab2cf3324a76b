"""Clustering, classification and evaluation queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur.functions.vectors import as_vector, euclidean, nearest_centre
from larkspur.operators import bayes as nb, classify as cl, clustering as km, corpus, evaluate as ev, features as ft
from larkspur.plans import tables as t
from larkspur.plans.registry import query, r6, sql_bucket, sql_r6
from larkspur.plans.text_queries import INDEX_SQL, cover_rows, entries_sql
from larkspur.session import scratch_path, spread, stored_copy
from larkspur.sources import stores

# --- clustering -----------------------------------------------------------------------

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORIES = ["l_linestatus", "o_orderpriority", "p_type"]


@query("label_counts", "select l_returnflag as label, count(*) as n from lineitem group by 1 order by n desc, label")
def label_counts(spark, sf):
    return km.label_counts(t.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("label")))


@query("cluster_label_counts", f"with {t.CENTRES_SQL} select cluster, label, count(*) as n from nearest group by 1, 2")
def cluster_label_counts(spark, sf):
    return km.cluster_label_counts(t.clustered(spark, sf))


@query("nearest_centroid", f"with {t.CENTRES_SQL} select vec_id, cluster, {sql_r6('distance')} as distance from nearest")
def nearest_centroid(spark, sf):
    return t.clustered(spark, sf).select("vec_id", "cluster", r6("distance").alias("distance"))


@query(
    "distance_to_label_mean",
    f"with {t.CENTRES_SQL} select vec_id, {sql_r6('distance')} as distance from dists where label = cluster",
)
def distance_to_label_mean(spark, sf):
    rows = t.vectors(spark, sf)
    ids, centres = km.group_means(rows, "label", "features")
    means = spark.createDataFrame(list(zip(ids, centres)), "label int, mean array<double>")
    # one row per label; group_means has checked how many there are
    both = rows.join(F.broadcast(means), "label")
    return both.select("vec_id", r6(euclidean(F.col("features"), F.col("mean"))).alias("distance"))


@query("mean_centroid_distance", f"with {t.CENTRES_SQL} select {sql_r6('avg(distance)')} as mean_distance from nearest")
def mean_centroid_distance(spark, sf):
    return km.mean_distance(t.clustered(spark, sf)).select(r6("mean_distance").alias("mean_distance"))


@query(
    "label_entropy",
    f"""select source, sum(n)::bigint as size, {sql_r6('-sum(n / total * ln(n / total))')} as entropy from (
  select source, lang, count(*) as n, sum(count(*)) over (partition by source) as total from documents group by 1, 2) group by 1""",
)
def label_entropy(spark, sf):
    counts = t.table(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return km.entropy_of_counts(counts, "n", "source").withColumn("entropy", r6("entropy"))


@query(
    "weighted_cluster_entropy",
    f"""with {t.CENTRES_SQL}, c as (select cluster, label, count(*) as n, sum(count(*)) over (partition by cluster) as size from nearest group by 1, 2),
e as (select cluster, max(size) as size, -sum(n / size * ln(n / size)) as entropy from c group by 1)
select {sql_r6('sum(size * entropy) / sum(size)')} as weighted_entropy from e""",
)
def weighted_cluster_entropy(spark, sf):
    return km.weighted_entropy(t.clustered(spark, sf)).select(r6("weighted_entropy").alias("weighted_entropy"))


ANOMALY_SQL = f"""{t.CENTRES_SQL},
threshold as (select min(distance) as least from (select distance from nearest order by distance desc limit 100)),
anomalies as (select nearest.* from nearest, threshold where distance > least)"""


@query("distance_anomalies", f"with {ANOMALY_SQL} select vec_id, cluster, {sql_r6('distance')} as distance from anomalies")
def distance_anomalies(spark, sf):
    found = km.distance_anomalies(t.clustered(spark, sf))
    return found.select("vec_id", "cluster", r6("distance").alias("distance"))


@query(
    "anomaly_rows",
    f"""with {ANOMALY_SQL}
select vec_id, label, cluster, {sql_r6('distance')} as distance from anomalies order by vec_id limit 10""",
)
def anomaly_rows(spark, sf):
    found = km.anomaly_rows(km.distance_anomalies(t.clustered(spark, sf)), ["vec_id"])
    return found.select("vec_id", "label", "cluster", r6("distance").alias("distance"))


def _raw(spark, sf):
    rows = spread(t.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("label"), *NUMERIC))
    return ft.assemble(rows, NUMERIC).select("label", "features")


def _scaled(spark, sf):
    return ft.zscore_vectors(_raw(spark, sf)).select("label", F.col("scaled").alias("features"))


def _scaled_one_hot(spark, sf, *keep):
    # joined once; indexing, counting and scaling read it
    rows = stored_copy(t.measurement_rows(spark, sf).withColumnRenamed("l_returnflag", "label"))
    hot = ft.one_hot(rows, NUMERIC, CATEGORIES)
    return ft.zscore_vectors(hot).drop("features").withColumnRenamed("scaled", "features").select("label", "features", *keep)


@query("kmeans_fit")
def kmeans_fit(spark, sf):
    rows = t.ml_vectors(spark, sf)
    model = km.kmeans_fit(rows)
    return km.cluster_label_counts(model.transform(rows))


@query("kmeans_nearest_check", "select count(*) as n, 0::bigint as not_nearest, count(distinct label) as labels from embeddings")
def kmeans_nearest_check(spark, sf):
    """Rows that the fitted model puts in a cluster whose stored centre is not the closest one, and how many rows there are."""
    rows = t.ml_vectors(spark, sf)
    model = km.kmeans_fit(rows, k=10)
    centres = [[float(x) for x in c] for c in model.clusterCenters()]
    placed = model.transform(rows).withColumn("v", vector_to_array("features"))
    nearest = placed.withColumn("near", nearest_centre("v", centres))
    own = F.get(F.array(*[F.array(*[F.lit(x) for x in c]) for c in centres]), F.col("cluster"))
    worse = euclidean(F.col("v"), own) > F.col("near.distance") + 1e-6
    return nearest.agg(F.count("*").alias("n"), F.count_if(worse).alias("not_nearest"), F.count_distinct("label").alias("labels"))


@query("kmeans_sweep_raw")
def kmeans_sweep_raw(spark, sf):
    rows = _raw(spark, sf)
    short = km.sweep(rows, km.steps(km.RAW_SWEEP), max_iter=100, tol=1.0e-4)
    long = km.sweep(rows, km.steps(km.RAW_SWEEP_LONG))
    return short.withColumn("sweep", F.lit("short")).unionByName(long.withColumn("sweep", F.lit("long")))


@query("kmeans_sweep_scaled")
def kmeans_sweep_scaled(spark, sf):
    return km.sweep(_scaled(spark, sf), km.steps(km.SCALED_SWEEP))


@query("kmeans_sweep_onehot")
def kmeans_sweep_onehot(spark, sf):
    return km.sweep(_scaled_one_hot(spark, sf), km.steps(km.ONE_HOT_SWEEP))


@query("kmeans_sweep_entropy")
def kmeans_sweep_entropy(spark, sf):
    return km.sweep(_scaled_one_hot(spark, sf), km.steps(km.ENTROPY_SWEEP), label="label")


@query("kmeans_anomalies")
def kmeans_anomalies(spark, sf):
    rows = _scaled_one_hot(spark, sf, "l_orderkey", "l_linenumber", *NUMERIC)
    found = km.anomaly_detector(rows)
    return found.select("l_orderkey", "l_linenumber", "label", *NUMERIC, "cluster", "distance")


# --- evaluation -------------------------------------------------------------------------

PAIRS_SQL = f"{t.CENTRES_SQL}, pairs as (select label as actual, cluster as predicted from nearest)"


def _pairs(spark, sf):
    return t.clustered(spark, sf).select("label", F.col("cluster").alias("prediction"))


@query(
    "confusion_matrix",
    f"""with {PAIRS_SQL}, labels as (select actual as label from pairs union select predicted from pairs)
select a.label as actual, p.label as predicted, count(pairs.actual) as n
from labels a cross join labels p left join pairs on pairs.actual = a.label and pairs.predicted = p.label group by 1, 2""",
)
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(_pairs(spark, sf))


PRF_SQL = f"""{PAIRS_SQL}, labels as (select actual as label from pairs union select predicted from pairs),
sums as (
  select label, count(*) filter (actual = label) as actual_n, count(*) filter (predicted = label) as predicted_n,
         count(*) filter (actual = label and predicted = label) as tp from labels, pairs group by 1),
prf as (
  select label, actual_n, case when predicted_n > 0 then 100.0 * tp / predicted_n else 0 end as p,
         case when actual_n > 0 then 100.0 * tp / actual_n else 0 end as r from sums),
scored as (select *, case when p + r > 0 then 2 * p * r / (p + r) else 0 end as f from prf)"""


@query(
    "per_label_prf",
    f"""with {PRF_SQL} select label, actual_n, {sql_r6('f')} as f_measure, {sql_r6('p')} as "precision", {sql_r6('r')} as recall from scored""",
)
def per_label_prf(spark, sf):
    scored = ev.per_label_scores(_pairs(spark, sf))
    return scored.select("label", "actual_n", *[r6(c).alias(c) for c in ("f_measure", "precision", "recall")])


@query(
    "weighted_metrics",
    f"""with {PRF_SQL}, hits as (select avg(case when actual = predicted then 100.0 else 0.0 end) as accuracy from pairs)
select {sql_r6('sum(f * actual_n) / sum(actual_n)')} as weighted_f, {sql_r6('sum(p * actual_n) / sum(actual_n)')} as weighted_precision,
       {sql_r6('sum(r * actual_n) / sum(actual_n)')} as weighted_recall, {sql_r6('sum(r * actual_n) / sum(actual_n)')} as true_positive_rate,
       {sql_r6('max(accuracy)')} as accuracy from scored, hits""",
)
def weighted_metrics(spark, sf):
    scored = ev.weighted_scores(_pairs(spark, sf))
    return scored.select(*[r6(c).alias(c) for c in scored.columns])


@query("accuracy", f"with {PAIRS_SQL} select {sql_r6('avg(case when actual = predicted then 1.0 else 0.0 end)')} as accuracy from pairs")
def accuracy(spark, sf):
    return ev.accuracy(_pairs(spark, sf)).select(r6("accuracy").alias("accuracy"))


@query(
    "random_baseline",
    f"""with parts as (select lang, {sql_bucket('doc_id', 100)} < 90 as train from documents),
shares as (select lang, count(*) filter (train) / sum(count(*) filter (train)) over () as a,
           count(*) filter (not train) / sum(count(*) filter (not train)) over () as b from parts group by 1)
select {sql_r6('sum(a * b)')} as accuracy from shares""",
)
def random_baseline(spark, sf):
    rows = t.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"))
    train, test = cl.hash_split(rows, "doc_id", {"train": 90, "test": 10})
    return ev.random_baseline(train, test).select(r6("accuracy").alias("accuracy"))


STEPS_SQL = """scored as (select quality as label, n_chars::double as score from labels join documents using (doc_id)),
totals as (select count(*) filter (label = 1) as p, count(*) filter (label = 0) as n from scored),
cuts as (select distinct score as threshold from scored),
steps as (
  select threshold, count(*) filter (label = 1) as tp, count(*) filter (label = 0) as fp
  from cuts join scored on score >= threshold group by 1),
fs as (select threshold, 2.0 * tp / (p + tp + fp) as f from steps, totals)"""


def _scored(spark, sf):
    lengths = t.table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return t.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")).join(lengths, "doc_id")


@query(
    "f_by_threshold",
    f"with {STEPS_SQL} select threshold, {sql_r6('f')} as f_measure from fs",
)
def f_by_threshold(spark, sf):
    return ev.f_by_threshold(_scored(spark, sf)).withColumn("f_measure", r6("f_measure"))


@query(
    "best_f_threshold",
    f"with {STEPS_SQL} select threshold, {sql_r6('f')} as f_measure from fs order by f desc, threshold desc limit 1",
)
def best_f_threshold(spark, sf):
    return ev.best_f_threshold(_scored(spark, sf)).withColumn("f_measure", r6("f_measure"))


@query(
    "roc_points",
    f"with {STEPS_SQL} select threshold, {sql_r6('fp / n')} as fpr, {sql_r6('tp / p')} as tpr from steps, totals",
)
def roc_points(spark, sf):
    return ev.roc_points(_scored(spark, sf)).select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query(
    "roc_area",
    """with scored as (select quality as label, n_chars as score from labels join documents using (doc_id))
select round(avg(case when a.score > b.score then 1.0 when a.score = b.score then 0.5 else 0.0 end), 6) as area
from scored a join scored b on a.label = 1 and b.label = 0""",
)
def roc_area(spark, sf):
    return ev.roc_area(_scored(spark, sf)).select(r6("area").alias("area"))


# --- classification ---------------------------------------------------------------------

DOC_SHARES = {"train": 80, "valid": 10, "test": 10}
TRAIN_PART = f"case when {sql_bucket('doc_id', 100)} < 90 then 0 else 1 end"
TRAIN_VALID_PART = f"case when {sql_bucket('doc_id', 100)} < 80 then 0 when {sql_bucket('doc_id', 100)} < 90 then 1 end"
FOLD_PART = sql_bucket("('10:' || doc_id)", 10)


def bayes_sql(fold: str, smoothings: str) -> str:
    """Steps to (doc_id, category, class, fold, smoothing, prediction) over content and title features: every fold by the others."""
    content, title = ft.content_recipe(), ft.title_recipe()
    return f"""{t.DOCS_SQL}, {INDEX_SQL}, {entries_sql(content)}, {entries_sql(title)},
wide as (select (select count(*) from {content.out}_vocabulary) as c, (select count(*) from {title.out}_vocabulary) as t),
entries as materialized (
  select doc_id, index, value from {content.out} where value <> 0
  union all select doc_id, index + c, value from {title.out}, wide where value <> 0),
parts as materialized (select doc_id, category, i as class, {fold} as fold from docs join idx using (category) where {fold} is not null),
folds as (select distinct fold from parts), classes as (select distinct class from parts), smooth as (select unnest({smoothings}) as s),
own as materialized (select fold, class, index, sum(value) as x from entries join parts using (doc_id) group by all),
total as (select class, index, sum(x) as x from own group by all),
own_mass as (select fold, class, sum(x) as x from own group by all), all_mass as (select class, sum(x) as x from total group by all),
mass as (select f.fold, a.class, a.x - coalesce(o.x, 0) as x from folds f cross join all_mass a left join own_mass o on o.fold = f.fold and o.class = a.class),
terms as (select distinct fold, index from own),
model as materialized (
  select e.fold, e.index, k.class, s, ln(greatest(0, coalesce(t.x, 0) - coalesce(o.x, 0)) + s) - ln(m.x + (c + t_wide) * s) as w
  from terms e cross join classes k cross join smooth cross join (select c, t as t_wide from wide)
  left join total t on t.class = k.class and t.index = e.index
  left join own o on o.fold = e.fold and o.class = k.class and o.index = e.index
  join mass m on m.fold = e.fold and m.class = k.class),
sizes as (select f.fold, k.class, count(*) filter (p.fold <> f.fold and p.class = k.class) as n, count(*) filter (p.fold <> f.fold) as everything
  from folds f cross join classes k cross join parts p group by all),
priors as (select fold, class, s, ln(n + s) - ln(everything + count(*) filter (n > 0) over (partition by fold, s) * s) as w from sizes, smooth where true),
sums as (select doc_id, m.class, s, sum(value * w) as x from entries join parts p using (doc_id) join model m using (fold, index) group by all),
scores as (select p.doc_id, p.category, p.class, p.fold, r.s, r.class as guess, r.w + coalesce(x, 0) as score
  from parts p join priors r using (fold) left join sums on sums.doc_id = p.doc_id and sums.class = r.class and sums.s = r.s),
predictions as materialized (
  select doc_id, category, class, fold, s, guess from scores qualify row_number() over (partition by doc_id, s order by score desc, guess) = 1)"""


def f1_sql(by: str) -> str:
    """(by, score): F1 weighted by the rows of each class."""
    return f"""sides as (
  select {by}, class as k, count(*) as a, 0 as g, count(*) filter (class = guess) as h from predictions group by all
  union all select {by}, guess, 0, count(*), 0 from predictions group by all),
per_class as (select {by}, k, sum(a) as a, sum(g) as g, sum(h) as h from sides group by all),
f as (select {by}, sum(2 * h / (a + g) * a) / sum(a) as score from per_class group by all)"""
BINARY_SHARES = {"train": 90, "test": 10}


def _labelled(spark, sf):
    """Stored document features with the language as class."""
    return t.feature_set(spark, sf)


def _quality(spark, sf):
    """The same with the binary quality label."""
    marks = t.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return t.feature_set(spark, sf).join(marks, "doc_id").select("doc_id", "label", ft.FEATURES)


def _multi_class(spark, sf, classifier, rows_per_task=None):
    train, test = cl.hash_split(_labelled(spark, sf), "doc_id", BINARY_SHARES)
    model = cl.fit(classifier, train, rows_per_task=rows_per_task)
    return model.transform(test).select("doc_id", "category", ft.LABEL, ft.PREDICTION)


def _binary(spark, sf, classifier):
    train, test = cl.hash_split(_quality(spark, sf), "doc_id", BINARY_SHARES)
    return cl.fit(classifier, train, "label").transform(test).select("doc_id", "label", ft.PREDICTION)


@query("decision_tree")
def decision_tree(spark, sf):
    return _multi_class(spark, sf, cl.decision_tree())


@query(
    "metrics_check",
    f"""select 'tree' as model, count(*) as n, 0::bigint as differ from documents where {sql_bucket('doc_id', 100)} >= 90
union all select 'bayes', count(*), 0 from documents where {sql_bucket('doc_id', 100)} >= 90""",
)
def metrics_check(spark, sf):
    """Metrics of stored predictions, from the library's evaluator and from counts: how many of them differ."""
    out = []
    for name, classifier in (("tree", cl.decision_tree()), ("bayes", cl.naive_bayes())):
        made = stored_copy(_multi_class(spark, sf, classifier).select(F.col(ft.LABEL).alias("label"), F.col(ft.PREDICTION).alias("prediction")), "predictions")
        counted = ev.weighted_scores(made).first()
        pairs = [("f1", "weighted_f"), ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall"), ("accuracy", "accuracy")]
        library = [cl.evaluator(m, "label").evaluate(made) for m, _ in pairs]
        differ = sum(abs(100 * x - counted[c]) > 1e-6 for x, (_, c) in zip(library, pairs))
        out.append((name, made.count(), differ))
    return spark.createDataFrame(out, "model string, n bigint, differ bigint")


@query("tree_grid")
def tree_grid(spark, sf):
    train, valid, _ = cl.hash_split(_labelled(spark, sf), "doc_id", DOC_SHARES)
    return cl.grid_search(train, valid, cl.decision_tree, cl.TREE_GRID, shared=False)


@query("refit_best")
def refit_best(spark, sf):
    parts = cl.hash_split(_labelled(spark, sf), "doc_id", DOC_SHARES)
    report, _ = cl.refit_best(*parts, cl.decision_tree, cl.TREE_GRID, shared=False)
    return report


def _cover(spark, sf):
    rows = cover_rows(spark, sf)
    vectors = rows.select("l_orderkey", F.col("label").cast("double").alias("label"), as_vector("features").alias("features"))
    return cl.declare_categories(vectors, "features", cl.COVER_WIDTH, cl.COVER_CATEGORIES)


def _plain_tree(**params):
    return cl.decision_tree("features", "label", **params)


@query("tree_categorical")
def tree_categorical(spark, sf):
    train, valid, test = cl.hash_split(_cover(spark, sf), "l_orderkey", DOC_SHARES)
    ranked = cl.grid_search(train, valid, _plain_tree, cl.TREE_GRID, "accuracy", "label", "features", train_metrics=True, shared=False)
    both = cl.declare_categories(corpus.union_parts(train, valid), "features", cl.COVER_WIDTH, cl.COVER_CATEGORIES)
    final = cl.fit(_plain_tree(**cl.FINAL_TREE), both, "label", "features")
    precision = cl.scores(final, test, ["weightedPrecision"], "label")[0]
    return ranked.withColumn("final_precision", F.lit(precision))


@query("split_scores")
def split_scores(spark, sf):
    names = list(DOC_SHARES)
    parts = dict(zip(names, cl.hash_split(_labelled(spark, sf), "doc_id", DOC_SHARES)))
    return cl.split_scores(cl.fit(cl.decision_tree(), parts["train"]), parts)


@query("random_forest")
def random_forest(spark, sf):
    return _multi_class(spark, sf, cl.random_forest())


@query("forest_grid")
def forest_grid(spark, sf):
    train, valid, _ = cl.hash_split(_labelled(spark, sf), "doc_id", DOC_SHARES)
    return cl.grid_search(train, valid, cl.random_forest, cl.FOREST_GRID)


@query("logistic_regression")
def logistic_regression(spark, sf):
    return _binary(spark, sf, cl.logistic_regression(label="label"))


@query("logistic_threshold")
def logistic_threshold(spark, sf):
    train, test = cl.hash_split(_quality(spark, sf), "doc_id", BINARY_SHARES)
    model = cl.fit(cl.logistic_regression(label="label"), train, "label")
    tuned, threshold, f_measure = cl.with_best_threshold(model, train)
    rows = ev.pair_counts(tuned.transform(test), "label", ft.PREDICTION)
    return rows.select("actual", "predicted", "n", F.lit(threshold).alias("threshold"), F.lit(f_measure).alias("f_measure"))


@query("logistic_history")
def logistic_history(spark, sf):
    model = cl.fit(cl.logistic_regression(label="label"), _quality(spark, sf), "label")
    return spark.createDataFrame(list(enumerate(model.summary.objectiveHistory)), "iteration int, objective double")


@query("linear_svm")
def linear_svm(spark, sf):
    return _binary(spark, sf, cl.linear_svm(label="label"))


@query("ovr_svm")
def ovr_svm(spark, sf):
    return _multi_class(spark, sf, cl.one_vs_rest(cl.linear_svm()))


@query(
    "naive_bayes",
    f"""with {bayes_sql(TRAIN_PART, "[1.0]")}
select doc_id, category, class::double as "{ft.LABEL}", guess::double as "{ft.PREDICTION}" from predictions where fold = 1""",
)
def naive_bayes(spark, sf):
    return _multi_class(spark, sf, cl.naive_bayes())


@query("perceptron")
def perceptron(spark, sf):
    rows = _labelled(spark, sf)
    classes = rows.select(ft.LABEL).distinct().count()
    return _multi_class(spark, sf, cl.perceptron(cl.perceptron_layers(rows, classes)), rows_per_task=128)


@query("ovr_tree")
def ovr_tree(spark, sf):
    train, test = cl.hash_split(_labelled(spark, sf), "doc_id", BINARY_SHARES)
    model = cl.fit(cl.one_vs_rest(cl.decision_tree()), train)
    path = scratch_path(spark, "ovr-tree")
    stores.save_model(model, path)
    loaded = stores.load_model(path, type(model))
    return loaded.transform(test).select("doc_id", "category", ft.LABEL, ft.PREDICTION)


def _ovr_grid(spark, sf, build, grid):
    train, valid, _ = cl.hash_split(_labelled(spark, sf), "doc_id", DOC_SHARES)
    return cl.grid_search(train, valid, lambda **p: cl.one_vs_rest(build(**p)), grid, shared=False)


@query("ovr_tree_grid")
def ovr_tree_grid(spark, sf):
    return _ovr_grid(spark, sf, cl.decision_tree, cl.OVR_TREE_GRID)


def _width(rows):
    return cl.vector_width(rows)


@query(
    "ovr_bayes_grid",
    f"""with {bayes_sql(TRAIN_VALID_PART, "[1.0, 2.0, 5.0]")}, {f1_sql("s, fold")}
select s::varchar as smoothing, {sql_r6('score')} as score from f where fold = 1""",
)
def ovr_bayes_grid(spark, sf):
    """One class against the others; the prior's divisor is all that differs from one model of all classes, and it is the same for each."""
    rows = _labelled(spark, sf)
    train, valid, _ = cl.hash_split(rows, "doc_id", DOC_SHARES)
    predicted = nb.holdout_predictions(train, valid, _width(rows), cl.BAYES_GRID["smoothing"])
    scored = nb.weighted_f1(predicted, "smoothing")
    return scored.select(F.col("smoothing").cast("string").alias("smoothing"), r6("score").alias("score")).orderBy(F.desc("score"), "smoothing")


@query("ovr_logistic_grid")
def ovr_logistic_grid(spark, sf):
    return _ovr_grid(spark, sf, lambda **p: cl.logistic_regression(**{**cl.LOGISTIC, **p}), cl.LOGISTIC_GRID)


def _bayes_folds(spark, sf, smoothings):
    rows = cl.with_fold(_labelled(spark, sf), "doc_id")
    return nb.fold_scores(rows, _width(rows), smoothings)


@query(
    "kfold_scores",
    f"""with {bayes_sql(FOLD_PART, "[1.0]")}, {f1_sql("s, fold")} select '' as params, fold::int as fold, {sql_r6('score')} as score from f""",
)
def kfold_scores(spark, sf):
    return _bayes_folds(spark, sf, [1.0]).select(F.lit("").alias("params"), "fold", r6("score").alias("score"))


@query(
    "cv_pipeline",
    f"""with {bayes_sql(FOLD_PART, "[1.0, 2.0, 5.0]")}, {f1_sql("s, fold")}
select 'smoothing=' || s::varchar as params, {sql_r6('avg(score)')} as mean_score, count(*) as folds from f group by 1""",
)
def cv_pipeline(spark, sf):
    scored = _bayes_folds(spark, sf, cl.BAYES_GRID["smoothing"])
    means = cl.mean_fold_scores(scored.withColumn("params", F.concat(F.lit("smoothing="), F.col("smoothing").cast("string"))))
    return means.withColumn("mean_score", r6("mean_score"))


def _folded(rows):
    return cl.with_fold(rows, "doc_id")


@query("kfold_tree")
def kfold_tree(spark, sf):
    return cl.kfold_scores(_folded(_labelled(spark, sf)), cl.decision_tree)


@query("kfold_forest")
def kfold_forest(spark, sf):
    return cl.kfold_scores(_folded(_labelled(spark, sf)), cl.random_forest)


@query("kfold_svm")
def kfold_svm(spark, sf):
    return cl.kfold_scores(_folded(_quality(spark, sf)), lambda: cl.linear_svm(label="label"), label="label")


@query("kfold_ovr_svm")
def kfold_ovr_svm(spark, sf):
    return cl.kfold_scores(_folded(_labelled(spark, sf)), lambda: cl.one_vs_rest(cl.linear_svm()))


@query("kfold_logistic")
def kfold_logistic(spark, sf):
    return cl.kfold_scores(_folded(_quality(spark, sf)), lambda: cl.logistic_regression(label="label"), label="label")


@query("cv_tree")
def cv_tree(spark, sf):
    return cl.mean_fold_scores(cl.kfold_scores(_folded(_labelled(spark, sf)), cl.decision_tree, cl.TREE_GRID, shared=False))


@query("cv_logistic")
def cv_logistic(spark, sf):
    def build(**params):
        return cl.one_vs_rest(cl.logistic_regression(**{**cl.LOGISTIC, **params}))

    return cl.mean_fold_scores(cl.kfold_scores(_folded(_labelled(spark, sf)), build, cl.LOGISTIC_GRID))


@query("logistic_class_one")
def logistic_class_one(spark, sf):
    """Regularisation chosen by the F measure of class 1."""
    train, valid, _ = cl.hash_split(_quality(spark, sf), "doc_id", DOC_SHARES)

    def build(**params):
        return cl.logistic_regression(label="label", **{**cl.LOGISTIC, **params})

    return cl.grid_search(train, valid, build, cl.LOGISTIC_GRID, "fMeasureByLabel", "label")


@query("classifier_comparison")
def classifier_comparison(spark, sf):
    rows = _labelled(spark, sf)
    kinds = {
        "tree": cl.decision_tree,
        "forest": cl.random_forest,
        "svm": cl.linear_svm,
        "logistic": cl.logistic_regression,
    }
    names = [r[0] for r in rows.select("category").distinct().orderBy("category").collect()]
    return cl.compare_classifiers(rows, names, kinds)


@query("category_holdout")
def category_holdout(spark, sf):
    words = ft.extract_words(t.docs(spark, sf), t.STOP_WORDS).select("doc_id", "category", "filteredWords").cache()
    vocabulary = ft.vocabulary_terms(words, "filteredWords", ft.CONTENT_TERMS, ft.CONTENT_MIN_DOCS)
    names = [r[0] for r in words.select("category").distinct().orderBy("category").collect()]
    out = cl.category_holdout(words, names, "filteredWords", vocabulary)
    words.unpersist()
    return out


@query("batch_score")
def batch_score(spark, sf):
    rows = t.docs(spark, sf)
    recipes = [ft.content_recipe(t.STOP_WORDS), ft.title_recipe(t.STOP_WORDS)]
    model = ft.fit_features(rows, recipes, last=lambda: [cl.naive_bayes()])
    path = scratch_path(spark, "scoring")
    stores.save_model(model, path)
    loaded = stores.load_model(path)
    return cl.batch_score(loaded, rows, loaded.stages[0].labels, ["doc_id", "category"])
