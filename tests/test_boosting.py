import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from wavelattice.operators import boosting, models

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    made = []
    for i in range(300):
        a, b, c = (float(v) for v in rng.normal(size=3))
        y = 3.0 * (a > 0.3) + b * b + (a > 0.3) * (c > 0) + 0.01 * float(rng.normal())
        made.append((y, float(a + b > 0), i % 3, 1.0 + (a + b > 0), a, float(np.round(b, 1)), c))
    df = spark.createDataFrame(made, "y double, k double, fold int, w double, a double, b double, c double")
    return models.dealt(models.assemble(df, X).select("features", F.col("y").alias("label"), "k", "fold", "w"))


def column(df, name):
    return np.array([float(r[name] if name == "prediction" else r[name][1]) for r in df.select(name).collect()])


def test_grown_trees_are_those_of_separate_fits(rows):
    settings = [boosting.Setting(6, depth, 0.1, 1.0, without) for depth in (2, 4) for without in (1, None)]
    for s, model in zip(settings, boosting.grow(rows.select("features", "label", "fold"), settings, False, 7)):
        part = rows if s.without is None else rows.filter(F.col("fold") != s.without)
        own = GBTRegressor(maxIter=6, maxDepth=s.depth, stepSize=0.1).fit(part)
        assert (model.getNumTrees(), model.totalNumNodes) == (6, own.totalNumNodes)
        assert np.mean(np.isclose(column(model.transform(rows), "prediction"), column(own.transform(rows), "prediction"))) > 0.98
        assert np.allclose(column(model.first(3).transform(rows), "prediction"), column(models.prefix_model(own, 3).transform(rows), "prediction"), atol=0.2)


def test_grown_classifier_is_that_of_a_weighted_fit(rows):
    ready = rows.select("features", F.col("k").alias("label"), "fold", F.col("w").alias("weight"))
    model = boosting.grow(ready, [boosting.Setting(5, 3, 0.1, 1.0, None)], True, 7)[0]
    own = GBTClassifier(maxIter=5, maxDepth=3, stepSize=0.1, weightCol="weight").fit(ready)
    for name in ("prediction", "probability"):
        assert np.mean(np.isclose(column(model.transform(ready), name), column(own.transform(ready), name))) > 0.98


def test_trees_do_not_depend_on_the_parts(rows, monkeypatch):
    monkeypatch.setattr(boosting, "RENEW", 3)
    ready = rows.select("features", "label", "fold")
    settings = [boosting.Setting(7, 3, 0.1, 1.0, 0), boosting.Setting(4, 2, 0.3, 1.0, None)]
    one, three = (boosting.grow(r, settings, False, 7) for r in (ready.coalesce(1), ready.repartition(3).cache()))
    for a, b in zip(one, three):
        assert a.totalNumNodes == b.totalNumNodes
        assert np.mean(np.isclose(column(a.transform(ready), "prediction"), column(b.transform(ready), "prediction"))) > 0.98


def test_samples_reach_their_share_and_repeat(rows):
    ready = rows.select("features", "label", "fold")
    full, some, again = (boosting.grow(ready, [boosting.Setting(4, 3, 0.1, share, None)], False, 7)[0] for share in (1.0, 0.8, 0.8))
    assert not np.allclose(column(full.transform(ready), "prediction"), column(some.transform(ready), "prediction"))
    assert np.array_equal(column(some.transform(ready), "prediction"), column(again.transform(ready), "prediction"))


def test_a_boosted_search_takes_few_jobs_and_finds_the_best(spark, rows):
    sc = spark.sparkContext
    sc.setJobGroup("boosted-search", "")
    est, ev = GBTRegressor(seed=7), RegressionEvaluator(metricName="mse")
    found = models.search_grids({"gbt": (est, {"maxIter": [5, 20], "maxDepth": [2, 4], "stepSize": [0.1]},
                                         rows.select("features", "label", "fold"), ev)}, 3)["gbt"]
    sc.setJobGroup("", "")
    assert len(sc.statusTracker().getJobIdsForGroup("boosted-search")) < 100  # separate fits took several a tree
    assert len(found.scores) == 4
    assert found.best == min(found.scores, key=lambda s: s[1])[0] and found.model.getNumTrees() == found.best["maxIter"]
    by_fold = [ev.evaluate(GBTRegressor(**found.best).fit(rows.filter(F.col("fold") != f)).transform(rows.filter(F.col("fold") == f))) for f in range(3)]
    assert min(s for _, s in found.scores) == pytest.approx(np.mean(by_fold), rel=0.05)


def test_rows_without_labels_are_refused(spark, rows):
    with pytest.raises(ValueError):
        boosting.grow(rows.select("features", F.lit(None).cast("double").alias("label"), "fold"), [boosting.Setting(2, 2, 0.1, 1.0, None)], False, 7)


def test_refits_of_a_boosted_classifier_take_few_jobs(spark, rows):
    from pyspark.ml.functions import vector_to_array
    plain = rows.select(F.monotonically_increasing_id().alias("id"), F.col("k").cast("int").alias("label"),
                        *[vector_to_array("features")[i].alias(c) for i, c in enumerate(X)])
    plain = models.dealt(plain)
    for fit in (models.fit_gbt, models.fit_boost):
        fitted = fit(plain, X, iters=12, depth=3)
        sc = spark.sparkContext
        sc.setJobGroup("boosted-refit", "")
        again = fitted.refit(plain)
        sc.setJobGroup("", "")
        assert len(sc.statusTracker().getJobIdsForGroup("boosted-refit")) < 30  # a fit by Spark takes several a tree
        own, new = (np.array([r["prob"] for r in f.predict(plain, ["id"]).orderBy("id").collect()]) for f in (fitted, again))
        assert again.name == fitted.name and again.model.getNumTrees() == 12
        assert np.mean(np.abs(own - new)) < (0.005 if fit is models.fit_gbt else 0.1)


def test_searches_and_refits_of_dealt_rows_take_few_jobs(spark, rows, monkeypatch):
    from pyspark.ml.functions import vector_to_array
    monkeypatch.setattr(models, "FIT_ROWS", 50)  # so that 300 rows are dealt to several tasks
    plain = models.dealt(rows.select(F.monotonically_increasing_id().alias("id"), F.col("k").cast("int").alias("label"),
                                     *[vector_to_array("features")[i].alias(c) for i, c in enumerate(X)]).repartition(7))
    fitted = models.fit_gbt(plain, X, iters=12, depth=3)
    sc, counts = spark.sparkContext, []
    spread = models.dealt(rows.select("features", "label", "fold").repartition(7))
    assert spread.rdd.getNumPartitions() > 1
    for run in (lambda: fitted.refit(plain), lambda: models.grid_search(GBTRegressor(seed=7), {"maxIter": [20], "maxDepth": [2, 4]}, spread, RegressionEvaluator(), 3)):
        sc.setJobGroup(f"dealt-{len(counts)}", "")
        run()
        sc.setJobGroup("", "")
        counts.append(len(sc.statusTracker().getJobIdsForGroup(f"dealt-{len(counts)}")))
    assert max(counts) < 50  # several jobs a round before


def test_trees_of_a_joint_growth_stay_off_the_driver(rows):
    ready = rows.select("features", "label", "fold")
    settings = [boosting.Setting(5, 3, 0.1, 1.0, 0), boosting.Setting(9, 2, 0.3, 1.0, None)]
    for s, model in zip(settings, boosting.grow(ready.coalesce(1), settings, False, 7)):
        assert isinstance(model.trees, boosting.Written) and model.getNumTrees() == s.rounds
        assert model.totalNumNodes == sum(len(t[3]) for t in model.trees)
        assert model.first(2).totalNumNodes == sum(len(t[3]) for t in list(model.trees)[:2])
