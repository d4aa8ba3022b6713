import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from wavelattice.operators import explain, forests, metrics, models

X = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    made = []
    for i in range(500):
        a, b, c = (float(v) for v in rng.normal(size=3))
        made.append((i, int(a + b * b + 0.3 * float(rng.normal()) > 0.8), i % 3, a, round(b, 1), c, 1.0))
    return models.dealt(spark.createDataFrame(made, "id long, label int, fold int, a double, b double, c double, d double"))


def ready(rows):
    return models.assemble(rows, X).select("features", F.col("label").cast("double").alias("label"), "fold")


def by_hand(x, y, w, depth, leaf, count):
    """The best of all cuts of all features, by recursion: ``(feature, cut, left, right)`` or the value."""
    def loss(m):
        return (w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum()

    def grow(m, depth):
        best = (1e-9, None, None)
        if depth and loss(m) > 1e-9:
            for f in range(x.shape[1]):
                v = np.unique(x[m, f])
                for lo, hi in zip(v, v[1:]):
                    left = m & (x[:, f] <= lo)
                    if min(count[left].sum(), count[m & ~left].sum()) >= leaf:
                        gain = loss(m) - loss(left) - loss(m & ~left)
                        if gain > best[0] + 1e-9:
                            best = gain, f, (lo + hi) / 2
        if best[1] is None:
            return np.average(y[m], weights=w[m])
        left = x[:, best[1]] <= best[2]
        return best[1], best[2], grow(m & left, depth - 1), grow(m & ~left, depth - 1)

    return grow(w > 0, depth)


def values(x, tree):
    return np.array([next(t for t in descend(v, tree)) for v in x])


def descend(v, tree):
    while isinstance(tree, tuple):
        tree = tree[2] if v[tree[0]] <= tree[1] else tree[3]
    yield tree


@pytest.mark.parametrize("leaf,classes", [(1, True), (4, True), (1, False)])
def test_a_tree_takes_the_best_of_all_cuts(leaf, classes):
    rng = np.random.default_rng(leaf)
    x = rng.normal(size=(120, 3))
    x[:, 1] = np.round(x[:, 1], 1)
    y = x[:, 0] + x[:, 1] ** 2 + 0.2 * rng.normal(size=120)
    y = (y > 1).astype(float) if classes else y + 100.0
    w = rng.uniform(0.5, 2.0, 120)
    ranks = np.array([np.unique(v, return_inverse=True)[1] for v in x.T], np.int32)
    for number in range(3):
        feature, below, above, left, value, cover, gain = forests.grown_tree(ranks, y, w, 3, leaf, 3, 7, number)
        times = np.bincount(np.random.default_rng((7, number)).integers(0, 120, 120), minlength=120)
        cuts = [(np.unique(x[:, f])[lo] + np.unique(x[:, f])[hi]) / 2 for f, lo, hi in zip(feature, below, above)]
        got = value[forests.placed(x, (feature, np.array(cuts), left))]
        assert got[times > 0] == pytest.approx(values(x, by_hand(x, y, w * times, 3, leaf, times))[times > 0])
        assert cover[0] == pytest.approx((w * times).sum()) and len(feature) > 5


def test_large_forests_grow_within_tasks_and_stay_off_the_driver(spark, rows):
    sc = spark.sparkContext
    sc.setJobGroup("grown-forest", "")
    fit = models.fit_forest(rows, X, trees=60, depth=20)
    sc.setJobGroup("", "")
    assert len(sc.statusTracker().getJobIdsForGroup("grown-forest")) < 12  # a fit by Spark takes one for every level of some trees
    assert isinstance(fit.model, forests.Forest) and fit.model.getNumTrees == 60
    out = fit.predict(rows, ["id"]).toPandas()
    assert np.mean(out.pred == out.label) > 0.99
    importance = {r["feature"]: r["importance"] for r in models.feature_importance_topk(spark, fit, 4).collect()}
    assert sum(importance.values()) == pytest.approx(1.0) and importance["d"] == 0.0 and max(importance, key=importance.get) in "ab"
    assert models.model_complexity(spark, [fit]).first()[1:4] == ("nodes", fit.model.table().agg(F.sum("nodes")).first()[0], 60)
    held = fit.refit(rows.filter("fold <> 0")).predict(rows.filter("fold = 0"), ["id"])
    assert metrics.metric_table(held).first()["auc"] > 0.9


def test_trees_do_not_depend_on_how_rows_and_trees_are_dealt(spark, rows, monkeypatch):
    def shares(model):
        return {r["id"]: r["probability"][1] for r in model.transform(models.assemble(rows, X)).collect()}

    one = forests.grow(spark, forests.written(ready(rows), True), 12, 6, 1, 2, 7)
    monkeypatch.setattr(forests, "TASKS", 5)
    monkeypatch.setattr(forests, "SCORED", 100)
    other = forests.grow(spark, forests.written(ready(rows).repartition(4), True), 12, 6, 1, 2, 7)
    assert shares(one) == pytest.approx(shares(other)) and one.totalNumNodes == other.totalNumNodes
    lower = forests.grow(spark, forests.written(ready(rows), True), 7, 3, 1, 2, 7)
    assert shares(one.first(7).to_depth(3)) == pytest.approx(shares(lower))
    again = forests.grow(spark, forests.written(ready(rows), True), 12, 6, 1, 2, 8)
    assert shares(again) != pytest.approx(shares(one))


def test_cuts_are_not_binned(spark):
    # 20 neighbouring values of 4,000 stand out: no two of 31 candidate cuts enclose them
    df = spark.createDataFrame([(i, int(2000 <= i < 2020), float(i)) for i in range(4000)], "id long, label int, a double")
    fit = models.fit_forest(models.dealt(df), ["a"], trees=60, depth=20)
    out = fit.predict(df, ["id"]).toPandas()
    assert (out.pred != out.label).sum() <= 2
    binned = models._vector_fit("binned", models.forest(10, 20), models.dealt(df), ["a"], "label", "balanced_weight").predict(df, ["id"]).toPandas()
    assert (binned.pred != binned.label).sum() > 5


def test_a_forest_search_scores_like_separate_fits(spark, rows):
    evaluator = MulticlassClassificationEvaluator(metricName="f1")
    grid = {"numTrees": [10, 60], "maxDepth": [2, 20], "minInstancesPerNode": [1, 5]}
    found = models.grid_search(models.forest(), grid, ready(rows), evaluator, 3, 4)
    assert len(found.scores) == 8 and found.best == max(found.scores, key=lambda s: s[1])[0]
    written = forests.written(ready(rows), True)
    for p, score in found.scores[::3]:
        own = [evaluator.evaluate(forests.grow(spark, written, p["numTrees"], p["maxDepth"], p["minInstancesPerNode"], 2, models.S.SEED, f).transform(
            ready(rows).filter(F.col("fold") == f))) for f in range(3)]
        assert score == pytest.approx(np.mean(own))
    assert found.model.getNumTrees == found.best["numTrees"]


def test_a_regression_forest_search_finds_the_function(spark, rows):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor
    data = models.assemble(rows, X).select("features", (F.col("a") + F.col("b") * 2 + 50).alias("label"), "fold")
    found = models.search_grids({"rf": (RandomForestRegressor(seed=3), {"numTrees": [60], "maxDepth": [2, 12]}, data, RegressionEvaluator(metricName="mse"))}, 3)["rf"]
    assert found.best["maxDepth"] == 12 and min(s for _, s in found.scores) < 0.6
    assert {"yhat"} <= set(found.model.setPredictionCol("yhat").transform(data).columns)


def test_elimination_by_large_forests(rows):
    found = models.rfecv(rows.drop("fold"), X, "id", estimator=models.forest(60, 8))
    assert set(found["curve"]) == {1, 2, 3, 4} and set(found["selected"]) >= {"a", "b"}
    assert found["ranking"]["d"] >= found["ranking"]["c"]


def test_attributions_of_a_grown_forest_add_up(spark, rows):
    fit = models.fit_forest(rows, X, trees=60, depth=5)
    some = rows.limit(10)
    base = sum(t["value"][0] for t in ({"value": forests.trees_of(r.asDict())[3]} for r in fit.model.table().collect())) / 60
    prob = {r["id"]: r["prob"] for r in fit.score(some).collect()}
    for r in explain.tree_shap(some, fit).collect():
        assert base + sum(r["shap"]) == pytest.approx(prob[r["id"]])


def test_odd_labels_and_more_classes(spark, rows):
    with pytest.raises(ValueError):
        forests.written(ready(rows).withColumn("label", F.lit(None).cast("double")), True)
    with pytest.raises(ValueError):
        forests.written(ready(rows).filter("label > 5"), True)
    three = ready(rows).withColumn("label", F.col("label") + (F.col("fold") == 0).cast("double"))
    assert not forests.fits(forests.written(three, True))  # Spark's fit takes these


def test_kernel_features_are_not_kept_twice(rows, monkeypatch):
    seen, plain = [], models.LinearSVC.fit
    monkeypatch.setattr(models.LinearSVC, "fit", lambda self, df: seen.append((df.storageLevel.useMemory, df.storageLevel.useDisk)) or plain(self, df))
    models.fit_svm_rbf(rows, ["a", "b", "c"], size=32, max_iter=5)
    assert seen == [(False, False)]  # the fit keeps its own blocks of the lifted rows
