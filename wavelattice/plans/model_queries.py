"""Queries over points and features: neighbours, clustering, models, attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wavelattice import schema as S
from wavelattice.functions.scalars import rounded as r
from wavelattice.operators import augment, clustering, explain, grid, lsh, metrics, models, neighbors, profiling, splits
from wavelattice.operators.cleaning import drop_degenerate
from wavelattice.operators.paths import measurement_features
from wavelattice.plans import views as V
from wavelattice.plans.registry import query
from wavelattice.plans.views import rnd
from wavelattice.session import cut_lineage, scratch_path
from wavelattice.streaming.features import stream_features
from wavelattice.streaming.scoring import score_stream, stream_predictions

W = "WITH " + V.PTS
X = V.POINT_COLUMNS


def dist2(a: str, b: str) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in X)


# --- neighbours and oversampling -------------------------------------------------------------------

def knn_sql(where: str, k: int) -> str:
    return f"""near AS (SELECT * FROM (SELECT a.vec_id, b.vec_id AS neighbor, sqrt({dist2('a', 'b')}) AS distance,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY {dist2('a', 'b')}, b.vec_id) AS rank
    FROM pts a JOIN pts b ON a.vec_id <> b.vec_id WHERE {where}) WHERE rank <= {k})"""


@query("knn", f"{W}, {knn_sql('true', 5)} SELECT vec_id, neighbor, rank::INTEGER AS rank, {rnd('distance')} AS distance FROM near")
def _(spark, sf):
    out = neighbors.knn(V.pts(spark, sf), "vec_id", "vec", 5)
    return out.withColumn("distance", r(F.col("distance")))


@query("knn_self_join", f"{W}, {knn_sql('a.rare = 1 AND b.rare = 1', 5)} SELECT vec_id, neighbor, rank::INTEGER AS rank, {rnd('distance')} AS distance FROM near")
def _(spark, sf):
    out = neighbors.knn(V.pts(spark, sf).filter(F.col("rare") == 1), "vec_id", "vec", 5)
    return out.withColumn("distance", r(F.col("distance")))


@query("eps_neighbor_join", f"{W} SELECT a.vec_id, count(*) AS n_near FROM pts a JOIN pts b ON {dist2('a', 'b')} <= 1.44 GROUP BY a.vec_id")
def _(spark, sf):
    return grid.eps_neighbors(V.pts(spark, sf), "vec_id", "vec", 1.2)


@query("knn_approx")
def _(spark, sf):
    pts = V.pts(spark, sf)
    found = cut_lineage(lsh.approx_knn(pts, "vec_id", "vec", 5))
    share = lsh.recall(found, neighbors.knn(pts, "vec_id", "vec", 5), "vec_id").select("recall")
    return found.join(F.broadcast(share))  # one row


@query("smote", f"""{W}, {knn_sql('a.rare = 1 AND b.rare = 1', 5)}, c AS (SELECT count_if(rare = 1) AS n1, count_if(rare = 0) AS n0 FROM pts),
  ord AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM pts WHERE rare = 1),
  draw AS (SELECT i, floor({V.sql_uniform('i', '42|base')} * n1) AS base_pos, floor({V.sql_uniform('i', '42|near')} * 5) + 1 AS rank,
    {V.sql_uniform('i', '42|lam')} AS lam FROM (SELECT unnest(range(greatest(0, n0 - n1)::BIGINT)) AS i, n1 FROM c))
  SELECT d.i AS synth_id, o.vec_id AS base, n.neighbor, {rnd('d.lam')} AS lam, {', '.join(f"{rnd(f'a.{c} + d.lam * (b.{c} - a.{c})')} AS {c}" for c in X)}, 1 AS rare
  FROM draw d JOIN ord o ON o.pos = d.base_pos JOIN near n ON n.vec_id = o.vec_id AND n.rank = d.rank
  JOIN pts a ON a.vec_id = o.vec_id JOIN pts b ON b.vec_id = n.neighbor""")
def _(spark, sf):
    out = augment.smote(V.pts(spark, sf), "vec_id", X, "rare", 1.0, 5)
    return out.withColumns({c: r(F.col(c)) for c in ["lam", *X]})


# --- clustering --------------------------------------------------------------------------------------

# Example centres, two and three of them; the pattern repeats along the dimensions.
CENTRES = [pattern * (len(X) // 8) for pattern in ([0.05, 0.05, -0.05, -0.05, 0.05, 0.0, 0.05, 0.0], [-0.05, -0.05, 0.05, 0.05, 0.0, 0.05, -0.05, 0.05],
           [0.1, -0.1, 0.1, -0.1, 0.1, -0.1, 0.1, -0.1])]


def assigned_sql(n: int) -> str:
    d = [" + ".join(f"({c} - {v}::DOUBLE) * ({c} - {v}::DOUBLE)" for c, v in zip(X, centre)) for centre in CENTRES[:n]]
    pick = f"CASE WHEN d0 <= {'d1' if n == 2 else 'least(d1, d2)'} THEN 0 " + (
        "ELSE 1 END" if n == 2 else "WHEN d1 <= d2 THEN 1 ELSE 2 END")
    least = "least(d0, d1)" if n == 2 else "least(d0, d1, d2)"
    return (f"dd AS (SELECT *, {', '.join(f'{e} AS d{i}' for i, e in enumerate(d))} FROM pts), "
            f"assigned AS (SELECT *, {pick} AS cluster, {least} AS dist2 FROM dd)")


def assigned(spark, sf, n: int) -> DataFrame:
    return clustering.kmeans_assign(V.pts(spark, sf), X, CENTRES[:n])


@query("kmeans_assign", f"{W}, {assigned_sql(3)} SELECT vec_id, cluster, {rnd('dist2')} AS dist2 FROM assigned")
def _(spark, sf):
    return assigned(spark, sf, 3).select("vec_id", "cluster", r(F.col("dist2")).alias("dist2"))


@query("inertia", f"{W}, {assigned_sql(3)} SELECT {rnd('sum(dist2)', 5)} AS inertia, count(*) AS n FROM assigned")
def _(spark, sf):
    return clustering.inertia(assigned(spark, sf, 3)).withColumn("inertia", r(F.col("inertia"), 5))


@query("cluster_label_map", f"""{W}, {assigned_sql(2)}, a AS (SELECT avg((cluster = y)::INTEGER) AS a, avg((1 - cluster = y)::INTEGER) AS b FROM assigned)
  SELECT {rnd('a')} AS acc_identity, {rnd('b')} AS acc_flipped, (b > a)::INTEGER AS flip, {rnd('greatest(a, b)')} AS best_acc FROM a""")
def _(spark, sf):
    out = clustering.cluster_label_map(assigned(spark, sf, 2), "cluster", "y")
    return out.withColumns({c: r(F.col(c)) for c in ("acc_identity", "acc_flipped", "best_acc")})


@query("silhouette", f"""{W}, {assigned_sql(3)}, pair AS (SELECT a.vec_id, a.cluster AS own, b.cluster AS other, sum(sqrt({dist2('a', 'b')})) AS total, count(*) AS n
    FROM assigned a, assigned b GROUP BY a.vec_id, a.cluster, b.cluster),
  ab AS (SELECT vec_id, max(CASE WHEN own = other THEN n END) AS n_own, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
    min(CASE WHEN own <> other THEN total / n END) AS b FROM pair GROUP BY vec_id)
  SELECT {rnd('avg(CASE WHEN n_own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette, count(*) AS n FROM ab""")
def _(spark, sf):
    return clustering.silhouette(assigned(spark, sf, 3), "vec_id", "vec", ["cluster"]).select(
        r(F.col("silhouette")).alias("silhouette"), "n")


@query("silhouette_squared", f"""{W}, {assigned_sql(3)}, l AS (SELECT vec_id, cluster, unnest(range(1, len(vec) + 1)) AS i, unnest(vec)::DOUBLE AS v FROM assigned),
  m AS (SELECT cluster, i, avg(v) AS mean, avg(v * v) AS sq FROM l GROUP BY cluster, i), k AS (SELECT cluster, count(*)::DOUBLE AS n FROM assigned GROUP BY cluster),
  d AS (SELECT l.vec_id, l.cluster AS own, m.cluster AS other, sum(l.v * l.v + m.sq - 2 * l.v * m.mean) AS d FROM l JOIN m ON l.i = m.i GROUP BY ALL),
  ab AS (SELECT vec_id, max(CASE WHEN own = other THEN n END) AS n_own, max(CASE WHEN own = other AND n > 1 THEN d * n / (n - 1) END) AS a,
    min(CASE WHEN own <> other THEN d END) AS b FROM d JOIN k ON k.cluster = d.other GROUP BY vec_id)
  SELECT {rnd('avg(CASE WHEN n_own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette, count(*) AS n FROM ab""")
def _(spark, sf):
    return clustering.silhouette_squared(assigned(spark, sf, 3), X, ["cluster"]).select(
        r(F.col("silhouette")).alias("silhouette"), "n")


@query("adjusted_rand", f"""{W}, {assigned_sql(3)}, c AS (SELECT y, cluster, count(*)::DOUBLE AS n FROM assigned GROUP BY y, cluster),
  i AS (SELECT sum(n * (n - 1) / 2) AS v, sum(n) AS n FROM c), a AS (SELECT sum(n * (n - 1) / 2) AS v FROM (SELECT sum(n) AS n FROM c GROUP BY y)),
  b AS (SELECT sum(n * (n - 1) / 2) AS v FROM (SELECT sum(n) AS n FROM c GROUP BY cluster))
  SELECT {rnd('(i.v - a.v * b.v / (i.n * (i.n - 1) / 2)) / ((a.v + b.v) / 2 - a.v * b.v / (i.n * (i.n - 1) / 2))')} AS ari FROM i, a, b""")
def _(spark, sf):
    return clustering.adjusted_rand(assigned(spark, sf, 3), "y", "cluster").select(r(F.col("ari")).alias("ari"))


EPS, MIN_ROWS = 1.2, 10
DBSCAN = f"""near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM pts a JOIN pts b ON {dist2('a', 'b')} <= {EPS * EPS}),
  core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {MIN_ROWS}),
  edge AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
  reach AS (SELECT id AS a, id AS b FROM core UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
  comp AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
  num AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM comp)),
  lab AS (SELECT n.a AS vec_id, min(m.cluster) AS cluster FROM near n JOIN comp c ON c.id = n.b JOIN num m ON m.root = c.root
          WHERE n.a NOT IN (SELECT id FROM core) GROUP BY n.a
          UNION ALL SELECT c.id, m.cluster FROM comp c JOIN num m ON m.root = c.root),
  clustered AS (SELECT p.vec_id, p.y, coalesce(l.cluster, -1)::INTEGER AS cluster FROM pts p LEFT JOIN lab l ON p.vec_id = l.vec_id)"""


def clustered(spark, sf) -> DataFrame:
    return clustering.dbscan(V.pts(spark, sf), "vec_id", "vec", EPS, MIN_ROWS)


@query("dbscan", f"WITH RECURSIVE {V.PTS}, {DBSCAN} SELECT vec_id, cluster FROM clustered")
def _(spark, sf):
    return clustered(spark, sf)


@query("distinct_labels", f"""WITH RECURSIVE {V.PTS}, {DBSCAN} SELECT count(DISTINCT CASE WHEN cluster >= 0 THEN cluster END) AS n_clusters,
  count_if(cluster = -1)::BIGINT AS n_noise, count(*) AS n FROM clustered""")
def _(spark, sf):
    return clustering.distinct_labels(clustered(spark, sf))


@query("dbscan_accuracy", f"""WITH RECURSIVE {V.PTS}, {DBSCAN}, k AS (SELECT * FROM clustered WHERE cluster >= 0),
  top AS (SELECT sum(m) AS m FROM (SELECT max(n) AS m FROM (SELECT cluster, y, count(*) AS n FROM k GROUP BY cluster, y) GROUP BY cluster))
  SELECT {rnd('CASE WHEN count(DISTINCT cluster) >= 2 THEN greatest(avg((cluster = y)::INTEGER), avg((1 - cluster = y)::INTEGER)) ELSE 0 END')} AS accuracy,
    {rnd('coalesce(any_value(top.m) / count(*), 0)')} AS majority_accuracy, count(*) AS n_clustered FROM k, top""")
def _(spark, sf):
    labels = V.pts(spark, sf).select(F.col("vec_id").alias("_v"), "y")
    rows = clustered(spark, sf).join(labels, F.col("vec_id") == F.col("_v"))
    out = clustering.dbscan_accuracy(rows, "y")
    return out.withColumns({c: r(F.col(c)) for c in ("accuracy", "majority_accuracy")})


def _split_pts(spark, sf) -> DataFrame:
    return splits.stratified_split(V.pts(spark, sf), "vec_id", "y")


@query("kmeans_k2")
def _(spark, sf):
    rows = cut_lineage(splits.standard_scale(_split_pts(spark, sf), X))
    centres, _ = clustering.kmeans_fit(rows.filter(F.col("split") == "train"), X, 2)
    labelled = clustering.kmeans_assign(rows, X, centres)
    mapping = clustering.cluster_label_map(labelled.filter(F.col("split") == "test"), "cluster", "y")
    mapped = clustering.apply_label_map(labelled, mapping)
    acc = mapped.groupBy("split").agg(F.avg((F.col("cluster") == F.col("y")).cast("double")).alias("accuracy"), F.count("*").alias("n"))
    mapped = cut_lineage(mapped.withColumn("vec", F.array(*X)))
    test = mapped.filter(F.col("split") == "test")
    quality = clustering.silhouette(test, "vec_id", "vec", ["cluster"]).select("silhouette")
    fitted = clustering.silhouette(mapped.filter(F.col("split") == "train"), "vec_id", "vec", ["cluster"]).select(
        F.col("silhouette").alias("train_silhouette"))
    return acc.join(quality).join(fitted).join(clustering.adjusted_rand(test, "y", "cluster"))  # one-row tables


@query("elbow_silhouette")
def _(spark, sf):
    return clustering.elbow_silhouette(_split_pts(spark, sf).filter(F.col("split") == "train"), "vec_id", X)


@query("pca_2d")
def _(spark, sf):
    rows = splits.standard_scale(_split_pts(spark, sf), X)
    model = clustering.pca_fit(rows.filter(F.col("split") == "train"), X)
    return clustering.pca_project(rows.filter(F.col("split") == "test"), model).select(
        "vec_id", "y", "pc1", "pc2", F.lit(float(model["explained"][0])).alias("explained1"),
        F.lit(float(model["explained"][1])).alias("explained2"))


@query("covariance", f"""{W}, l AS (SELECT vec_id, unnest(range(1, len(vec) + 1)) AS i, unnest(vec) AS v FROM pts)
  SELECT 'x' || a.i AS a, 'x' || b.i AS b, {rnd('covar_pop(a.v, b.v)', 9)} AS cov
  FROM l a JOIN l b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def _(spark, sf):
    return profiling.centred_moments(V.pts(spark, sf), X).withColumn("cov", r(F.col("cov"), 9))


# --- regression in closed form, linear attribution ---------------------------------------------------

@query("reg_ridge", f"""WITH p AS (SELECT (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS a,
    (l_discount - avg(l_discount) OVER ()) / stddev_pop(l_discount) OVER () AS b, l_extendedprice AS y,
    l_extendedprice - avg(l_extendedprice) OVER () AS c FROM lineitem),
  g AS (SELECT sum(a * a) + 1 AS aa, sum(b * b) + 1 AS bb, sum(a * b) AS ab, sum(a * c) AS ay, sum(b * c) AS by_, avg(y) AS m FROM p),
  w AS (SELECT (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS wa, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS wb, m FROM g)
  SELECT count(*) AS n, {rnd('sqrt(avg((y - (m + wa * a + wb * b)) * (y - (m + wa * a + wb * b))))', 4)} AS rmse,
    {rnd('avg(abs(y - (m + wa * a + wb * b)))', 4)} AS mae FROM p, w""")
def _(spark, sf):
    rows = V.table(spark, sf, "lineitem").select("l_quantity", "l_discount", F.col("l_extendedprice").alias("y"))
    fit = models.fit_ridge(rows, ["l_quantity", "l_discount"], "y")
    scored = models.linear_score(rows, fit)
    e = F.col("y") - F.col("yhat")
    return scored.agg(F.count("*").alias("n"), r(F.sqrt(F.avg(e * e)), 4).alias("rmse"), r(F.avg(F.abs(e)), 4).alias("mae"))


@query("shap_importance", f"{W} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {rnd(f'avg(abs({i + 1} * ({c} - (SELECT avg({c}) FROM pts))))')} AS mean_abs_shap FROM pts" for i, c in enumerate(X)))
def _(spark, sf):
    out = explain.linear_shap(V.pts(spark, sf), X, [float(i + 1) for i in range(len(X))])
    return out.withColumn("mean_abs_shap", r(F.col("mean_abs_shap")))


# --- trained models: quality tables -------------------------------------------------------------------

def study(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of the expanded feature table; both paths of a measurement share the split."""
    split = splits.stratified_split(drop_degenerate(V.sig(spark, sf)), "sample_id", "NLOS")
    rows = measurement_features(split, keys=("sample_id", "env_id", "split"))
    rows = models.dealt(rows.withColumn("row_id", F.col("sample_id") * 2 + F.col("path_id")))
    return rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "test")


KEYS = ["sample_id", "path_id", "env_id"]


def _quality(fitted: models.Fitted, test: DataFrame) -> DataFrame:
    return metrics.model_summary_table(fitted.predict(test, KEYS))


def _classifier(name: str, fit) -> None:
    @query(name)
    def _(spark, sf):
        train, test = study(spark, sf)
        return _quality(fit(train), test)


_classifier("clf_logistic", lambda t: models.fit_logistic(t, S.FEATURES))
_classifier("clf_svm_rbf", lambda t: models.fit_svm_rbf(t, S.FEATURES))
_classifier("clf_random_forest", lambda t: models.fit_forest(t, S.FEATURES))
_classifier("clf_gbt", lambda t: models.fit_gbt(t, S.FEATURES))
_classifier("clf_xgb", lambda t: models.fit_boost(t, S.FEATURES))
_classifier("svm_grid", lambda t: models.fit_svm_grid(t, S.FEATURES, "row_id"))


@query("train_classifiers")
def _(spark, sf):
    train, test = study(spark, sf)
    found = models.train_classifiers(train, S.FEATURES, "row_id")
    return metrics.model_summary_table(models.predict_all(list(found.values()), test, KEYS))


@query("clf_waveform_nn")
def _(spark, sf):
    rows = splits.scale_and_split(V.clean(spark, sf))
    rows = cut_lineage(rows.select("sample_id", F.col("NLOS").alias("label"), "split", "cir", *S.SCALARS))
    fitted = models.fit_waveform_nn(rows.filter(F.col("split") == "train"), S.SCALARS)
    return metrics.model_summary_table(fitted.predict(rows.filter(F.col("split") == "test"), ["sample_id"]))


def _held_out(train: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """A tenth of the train rows for validation, the others to learn from."""
    folded = cut_lineage(splits.stratified_folds(train, key, "label", 10))
    return models.dealt(folded.filter("fold <> 0").drop("fold")), folded.filter("fold = 0").drop("fold")


@query("early_stop_boosting")
def _(spark, sf):
    """Where the validation loss of a boosted fit has its plateau, and the test quality of the model cut back to there."""
    train, test = study(spark, sf)
    learn, held = _held_out(train, "row_id")
    fitted = models.fit_gbt(learn, S.FEATURES)
    stop = metrics.plateau_early_stop(models.boosting_trace(fitted, held))
    cut = models.stopped_at(fitted, stop.first()["best_epoch"])  # one row
    return stop.drop("final_lr").join(F.broadcast(_quality(cut, test)))  # one row each


@query("early_stop_waveform_nn")
def _(spark, sf):
    """The epochs of the perceptron on raw waves until its validation loss stops improving, and where that was."""
    rows = splits.scale_and_split(V.clean(spark, sf))
    rows = cut_lineage(rows.select("sample_id", F.col("NLOS").alias("label"), "split", "cir", *S.SCALARS))
    learn, held = _held_out(rows.filter(F.col("split") == "train"), "sample_id")
    _, epochs = models.fit_waveform_nn_stopped(learn, held, S.SCALARS)
    return epochs.join(metrics.plateau_early_stop(epochs).select("run", "stop_epoch", "best_epoch", "final_lr"), "run")


@query("stream_scores")
def _(spark, sf):
    """A classifier fitted on the train rows scores the measurements as a file stream; its scores against those of a batch."""
    train, _ = study(spark, sf)
    fitted = models.fit_logistic(train, S.FEATURES)
    source, target = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-scores")
    V.sig(spark, sf).write.parquet(source)
    schema = spark.read.parquet(source).schema
    live = stream_features(spark.readStream.schema(schema).parquet(source))
    score_stream(live, fitted, KEYS, target, scratch_path(spark, "stream-state")).awaitTermination()
    batch = stream_predictions(stream_features(V.sig(spark, sf)), fitted, KEYS)
    both = spark.read.parquet(target).select("sample_id", "path_id", "prob", "pred").join(
        batch.select("sample_id", "path_id", F.col("prob").alias("batch_prob")), ["sample_id", "path_id"], "full")
    return both.select("sample_id", "path_id", r(F.col("prob")).alias("prob"), "pred", (r(F.col("prob")) == r(F.col("batch_prob"))).alias("same"))


@query("grid_search")
def _(spark, sf):
    train, test = study(spark, sf)
    fitted = models.fit_grid("random_forest", models.forest(), models.FOREST_GRID, train, S.FEATURES, "row_id")
    rows = [(p["numTrees"], p["maxDepth"], p["minInstancesPerNode"], s, p == fitted.params["best"]) for p, s in fitted.params["scores"]]
    return spark.createDataFrame(rows, "trees int, depth int, leaf int, f1_weighted double, chosen boolean")


@query("cross_val_predict")
def _(spark, sf):
    train, _ = study(spark, sf)
    return models.cross_val_predict(models.fit_forest(train, S.FEATURES), train, "row_id")


@query("ensemble_stacked")
def _(spark, sf):
    train, test = study(spark, sf)
    base = [models.fit_forest(train, S.FEATURES), models.fit_gbt(train, S.FEATURES)]
    stacked = models.fit_stacked(base, train, "row_id")
    long = models.predict_all([*base, stacked], test, KEYS)
    return metrics.model_summary_table(long)


_eliminated: dict = {}


def eliminated(spark, sf) -> dict:
    """One elimination for both reports of it."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _eliminated:
        train, _ = study(spark, sf)
        _eliminated[at] = models.rfecv(train, S.FEATURES, "row_id")
    return _eliminated[at]


@query("rfecv")
def _(spark, sf):
    found = eliminated(spark, sf)
    return spark.createDataFrame([(n, float(s), n == found["best"]) for n, s in found["curve"].items()],
                                 "n_features int, score double, chosen boolean")


@query("rfe_rank_top")
def _(spark, sf):
    found = eliminated(spark, sf)
    return spark.createDataFrame(list(found["ranking"].items()), "feature string, rank int").orderBy("rank", "feature").limit(10)


@query("argmax_optimal_n", f"""WITH c AS (SELECT l_linenumber AS n_features, round(avg(l_discount), 4) AS score FROM lineitem GROUP BY l_linenumber)
  SELECT n_features, {rnd('score')} AS score FROM c ORDER BY c.score DESC, n_features LIMIT 1""")
def _(spark, sf):
    curve = V.table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("n_features")).agg(
        F.round(F.avg("l_discount"), 4).alias("score"))
    return models.optimal_size(curve).withColumn("score", r(F.col("score")))


@query("feature_importance_topk")
def _(spark, sf):
    train, _ = study(spark, sf)
    return models.feature_importance_topk(spark, models.fit_forest(train, S.FEATURES), 20)


@query("model_complexity")
def _(spark, sf):
    train, _ = study(spark, sf)
    return models.model_complexity(spark, [models.fit_forest(train, S.FEATURES), models.fit_gbt(train, S.FEATURES),
                                           models.fit_logistic(train, S.FEATURES)])


@query("permutation_importance")
def _(spark, sf):
    train, test = study(spark, sf)
    return explain.permutation_importance(models.fit_forest(train, S.FEATURES), test, "row_id")


@query("tree_shap_importance")
def _(spark, sf):
    train, test = study(spark, sf)
    return explain.tree_shap_importance(test, models.fit_forest(train, S.FEATURES))


@query("rf_on_smote")
def _(spark, sf):
    train, test = study(spark, sf)
    plain = models.fit_forest(train, S.FEATURES)
    more = augment.with_smote(train, "row_id", S.FEATURES, "label", 0.5, 5)
    again = models.fit_forest(cut_lineage(more), S.FEATURES)
    before = metrics.metric_table(plain.predict(test, KEYS))
    return metrics.metric_delta(before, metrics.metric_table(again.predict(test, KEYS)))


def _regression(name: str, path_id: int) -> None:
    @query(name)
    def _(spark, sf):
        train, test = study(spark, sf)
        return metrics.regression_metrics(models.path_regression(train.unionByName(test), path_id))


@query("reg_ridge_paths")
def _(spark, sf):
    """Ridge on the 25 features of the first path, and on these and the range of the second, scored on test rows."""
    train, test = study(spark, sf)
    rows = train.unionByName(test)
    out = [metrics.regression_metrics(models.path_regression(rows, p, only=["ridge"])).withColumn("path_id", F.lit(p)) for p in (1, 2)]
    return out[0].unionByName(out[1])


_regression("reg_path1", 1)
_regression("reg_path2", 2)


def _tree_regressor(name: str, family: str) -> None:
    @query(name)
    def _(spark, sf):
        train, test = study(spark, sf)
        out = models.path_regression(train.unionByName(test), 1, only=[family])
        return metrics.regression_metrics(out.withColumn("model", F.lit(name)))


_tree_regressor("reg_random_forest", "random_forest")
_tree_regressor("reg_gbt", "gbt")
_tree_regressor("reg_xgb", "boost")
