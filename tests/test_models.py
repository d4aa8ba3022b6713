import numpy as np
import pytest
from pyspark.sql import functions as F

from wavelattice.operators import augment, explain, metrics, models, profiling
from wavelattice.operators.splits import stratified_split

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.35)
        rows.append((i, y, float(rng.normal(2.5 * y)), float(rng.normal(-2 * y, 2)), float(rng.normal())))
    df = spark.createDataFrame(rows, "id long, label int, a double, b double, c double")
    split = stratified_split(df, "id", "label").cache()
    return split.filter("split = 'train'"), split.filter("split = 'test'")


def accuracy(fitted, test):
    return metrics.metric_table(fitted.predict(test, ["id"])).first()


def test_logistic_is_the_optimum_of_the_weighted_penalised_loss(data):
    train, test = data
    fit = models.fit_logistic(train, X)
    pdf = train.toPandas()
    z = (pdf[X] - pdf[X].mean()) / pdf[X].std(ddof=0)
    n = pdf.label.value_counts()
    w = pdf.label.map(lambda y: len(pdf) / (2 * n[y])).to_numpy()
    beta = fit.model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(z.to_numpy() @ beta + fit.model.intercept)))
    gradient = z.to_numpy().T @ (w * (p - pdf.label.to_numpy())) + beta
    assert np.abs(gradient).max() < 0.05 and abs((w * (p - pdf.label)).sum()) < 0.05
    assert accuracy(fit, test)["auc"] > 0.85


def test_tree_and_kernel_models_separate_the_classes(data):
    train, test = data
    for fit in (models.fit_forest(train, X, trees=10, depth=5), models.fit_gbt(train, X, iters=5, depth=3),
                models.fit_svm_rbf(train, X, size=64, max_iter=15)):
        r = accuracy(fit, test)
        assert r["auc"] > 0.85 and r["accuracy"] > 0.75, fit.name


def test_stacking_and_out_of_fold_rows(data):
    train, test = data
    base = [models.fit_forest(train, X, trees=5, depth=4), models.fit_gbt(train, X, iters=2, depth=3)]
    oof = models.cross_val_predict(base[0], train, "id", folds=3)
    assert oof.count() == train.count() == oof.select("id").distinct().count()
    stacked = models.fit_stacked(base, train, "id", folds=3)
    out = models.predict_all([*base, stacked], test, ["id"])
    assert out.groupBy("model").count().filter(F.col("count") != test.count()).isEmpty()
    assert {r["model"]: r["auc"] for r in metrics.auc_trapezoid(out).collect()}["ensemble_stacked"] > 0.85
    with pytest.raises(ValueError):
        models.fit_stacked(base[:1], train, "id")


def test_feature_elimination_drops_the_noise_column_first(data):
    found = models.rfecv(data[0], X, "id", estimator=models.forest(5, 4))
    assert found["best"] == len(found["selected"]) and set(found["curve"]) == {1, 2, 3}
    assert found["best"] == 3 or max(found["ranking"], key=found["ranking"].get) != "a"


def test_importances(data):
    train, test = data
    fit = models.fit_forest(train, X, trees=10, depth=5)
    drop = {r["feature"]: r["importance"] for r in explain.permutation_importance(fit, test, "id").collect()}
    assert set(drop) == set(X) and max(drop, key=drop.get) == "a"
    linear = {r["feature"]: r["mean_abs_shap"] for r in explain.linear_shap(test, X, [2.0, 0.0, -1.0]).collect()}
    pdf = test.toPandas()
    assert linear["a"] == pytest.approx(2 * (pdf.a - pdf.a.mean()).abs().mean()) and linear["b"] == 0


def test_ridge_equals_the_closed_form(data):
    train, _ = data
    target = train.withColumn("y", 3 * F.col("a") - F.col("b") + 0.2 * F.col("c") * F.col("c"))
    fit = models.fit_ridge(target, X, "y", alpha=5.0)
    pdf = target.toPandas()
    z = ((pdf[X] - pdf[X].mean()) / pdf[X].std(ddof=0)).to_numpy()
    w = np.linalg.solve(z.T @ z + 5.0 * np.eye(3), z.T @ (pdf.y - pdf.y.mean())) / pdf[X].std(ddof=0).to_numpy()
    assert fit["coef"] == pytest.approx(w)
    assert fit["intercept"] == pytest.approx(pdf.y.mean() - pdf[X].mean().to_numpy() @ w)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 2 + [(1,)] * 6, "label int")
    w = {r["label"]: r for r in profiling.class_weights(df, "label").collect()}
    assert (w[0]["balanced_weight"], w[1]["balanced_weight"]) == pytest.approx((2.0, 8 / 12))
    assert w[0]["boost_weight"] / w[1]["boost_weight"] == pytest.approx(3.0)
    assert 2 * w[0]["boost_weight"] + 6 * w[1]["boost_weight"] == pytest.approx(8.0)
    assert w[1]["scale_pos_weight"] == pytest.approx(1 / 3)


def test_augmentation(spark):
    wave = [float(v) for v in np.random.default_rng(0).random(200)]
    df = spark.createDataFrame([(i, wave, i % 2) for i in range(50)], "sample_id long, cir array<double>, label int")
    out = augment.augment_waveforms(df, factor=3, noise_level=0.1, max_shift=4)
    rows = out.collect()
    assert len(rows) == 200 and sum(r["aug_round"] == 0 for r in rows) == 50
    again = augment.augment_waveforms(df.repartition(7), factor=3, noise_level=0.1, max_shift=4).collect()
    key = lambda r: (r["aug_round"], r["sample_id"])
    assert sorted(rows, key=key) == sorted(again, key=key)
    noisy = df.select(augment.noise(F.col("cir"), F.col("sample_id"), 0.1).alias("w")).collect()
    e = np.array([r["w"] for r in noisy]) - np.array(wave)
    assert e.std() == pytest.approx(0.1 * np.std(wave), rel=0.05) and abs(e.mean()) < 0.002


def test_tree_attributions_are_shapley_values(spark, data):
    from itertools import combinations
    from math import factorial
    train, test = data
    rows = test.limit(12).cache()
    for fit, margin in ((models.fit_forest(train, X, trees=3, depth=4), False), (models.fit_gbt(train, X, iters=2, depth=3), True)):
        leaves = explain._leaves(fit, spark)

        def value(x, known):
            total = 0.0
            for feats, lo, hi, z, v in leaves:
                for f, a, b, share in zip(feats, lo, hi, z):
                    v = v * (float(a < x[f] <= b) if f in known else share)
                total += v
            return total

        scored = fit.model.transform(models.assemble(rows, X)).collect()
        got = {r["id"]: r["shap"] for r in explain.tree_shap(rows, fit).collect()}
        for r in scored:
            x = [r[c] for c in X]
            whole = value(x, {0, 1, 2})
            assert whole == pytest.approx(r["rawPrediction"][1] if margin else r["probability"][1])
            for j in range(3):
                others = [i for i in range(3) if i != j]
                want = sum(factorial(k) * factorial(2 - k) / 6 * (value(x, {*s, j}) - value(x, set(s)))
                           for k in range(3) for s in combinations(others, k))
                assert got[r["id"]][j] == pytest.approx(want, abs=1e-9)
        imp = {r["feature"]: r["mean_abs_shap"] for r in explain.tree_shap_importance(test, fit).collect()}
        assert max(imp, key=imp.get) == "a"


def ready_rows(rows):
    return models.assemble(rows, X).select("features", F.col("label").cast("double").alias("label"), (F.col("id") % 2).alias("fold"))


def predictions(model, rows):
    return [(r["prediction"], *r["features"]) for r in model.transform(rows).select("prediction", "features").collect()]


def test_prefix_of_boosting_is_the_fit_with_fewer_rounds(data):
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    rows = ready_rows(data[0]).coalesce(1).cache()
    for make in (lambda n: models.boosted(n, 3, 0.3, 0.8), lambda n: GBTRegressor(maxIter=n, maxDepth=3, seed=5, subsamplingRate=0.7)):
        short, long = make(3).fit(rows), make(7).fit(rows)
        assert predictions(models.prefix_model(long, 3), rows) == predictions(short, rows) != predictions(long, rows)
    for est in (models.forest(9, 4), RandomForestRegressor(numTrees=9, maxDepth=4)):
        whole = est.fit(rows)
        part = models.prefix_model(whole, 4)
        assert part.getNumTrees == 4 == len(part.trees) and whole.getNumTrees == 9
        if isinstance(est, RandomForestRegressor):
            vectors = [r["features"] for r in rows.collect()]
            assert [p for p, *_ in predictions(part, rows)] == pytest.approx([np.mean([t.predict(v) for t in whole.trees[:4]]) for v in vectors])


def test_staged_search_scores_like_separate_fits(data):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = ready_rows(data[0]).coalesce(1).cache()
    evaluator = MulticlassClassificationEvaluator(metricName="f1")
    est = models.boosted(1, 1)
    found = models.grid_search(est, {"maxIter": [2, 5], "maxDepth": [2, 20], "stepSize": [0.1, 0.5]}, rows, evaluator, 2, 4)
    assert len(found.scores) == 8
    for point, score in found.scores:
        one = est.copy({est.getParam(k): v for k, v in point.items()})
        want = np.mean([evaluator.evaluate(one.fit(rows.filter(F.col("fold") != f)).transform(rows.filter(F.col("fold") == f))) for f in (0, 1)])
        assert score == pytest.approx(want)
    assert found.best == max(found.scores, key=lambda s: s[1])[0]


def test_deeper_limits_reuse_trees_that_end_before(data, monkeypatch):
    rows = ready_rows(data[0]).coalesce(1).cache()
    fits = []
    est = models.forest(6, 3)
    plain = type(est).fit
    monkeypatch.setattr(type(est), "fit", lambda self, df: fits.append(self.getMaxDepth()) or plain(self, df))
    chain = [{"maxDepth": d, "numTrees": n} for d in (2, 25, 30) for n in (4, 6)]
    scores = models._fit_chain(est, chain, rows, lambda m: (m.getNumTrees, predictions(m, rows)))
    assert fits == [2, 25] and scores[2:4] == scores[4:6] and [s[0] for s in scores] == [4, 6] * 3
    assert scores[5][1] == predictions(plain(est.copy({est.maxDepth: 30}), rows), rows)


def test_boosting_stops_at_its_plateau(data):
    train, test = data
    fitted = models.fit_gbt(train, X, iters=12, depth=4, step=0.9)
    trace = models.boosting_trace(fitted, test)
    losses = [r["val_loss"] for r in trace.orderBy("epoch").collect()]
    assert len(losses) == 12
    stop = metrics.plateau_early_stop(trace, patience=3).first()
    cut = models.stopped_at(fitted, stop["best_epoch"])
    assert len(cut.model.trees) == stop["best_epoch"] <= 12 and cut.score(test).columns == [*test.columns, "prob"]
    assert models.boosting_trace(cut, test).agg(F.min("val_loss")).first()[0] == pytest.approx(stop["best_loss"])
    assert stop["best_loss"] == pytest.approx(min(losses[:stop["last_epoch"]]))


def test_perceptron_goes_on_from_its_weights_until_the_plateau(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(y), [float(v) for v in rng.normal(size=16) + y * np.linspace(0, 2, 16)], float(rng.normal())) for i, y in enumerate(rng.integers(0, 2, 300))]
    df = spark.createDataFrame(rows, "id long, label int, cir array<double>, s double")
    fitted, epochs = models.fit_waveform_nn_stopped(df.filter("id < 200"), df.filter("id >= 200"), ["s"], parts=4, hidden=(5,), steps=3, max_epochs=12, patience=2)
    losses = [r["val_loss"] for r in epochs.orderBy("epoch").collect()]
    best = int(np.argmin(losses))
    assert losses[best] < losses[0] and (len(losses) == 12 or len(losses) == best + 3)
    p = fitted.predict(df.filter("id >= 200"), ["id"]).toPandas()
    again = -np.where(p.label == 1, np.log(p.prob.clip(1e-12, 1 - 1e-12)), np.log(1 - p.prob.clip(1e-12, 1 - 1e-12))).mean()
    assert again == pytest.approx(losses[best])


def test_class_ratio_weights(data):
    w = {r["label"]: r["weight"] for r in profiling.attach_weights(data[0], "label", "pos_weight").select("label", "weight").distinct().collect()}
    n = {r["label"]: r["count"] for r in data[0].groupBy("label").count().collect()}
    assert w == {0: 1.0, 1: pytest.approx(n[0] / n[1])}


def test_queries_fit_whole_grids_and_sizes(spark, data, monkeypatch):
    from wavelattice.plans import catalog, model_queries

    class Asked(Exception):
        pass

    def asked(name, *places):
        def stop(*args, **options):
            seen.append((name, *[args[i] if isinstance(i, int) else options.get(i) for i in places]))
            raise Asked
        return stop

    seen = []
    rows = data[0].select(F.col("id").alias("row_id"), F.col("id").alias("sample_id"), "label", "split", F.lit(1).alias("path_id"),
                          F.col("a").alias("range_m"), *[F.col("b").alias(c) for c in model_queries.S.FEATURES])
    monkeypatch.setattr(model_queries, "study", lambda spark, sf: (rows, rows))

    def searched(jobs, folds, parallelism):
        seen.append((sorted((name, grid) for name, (_, grid, _, _) in jobs.items()), folds))
        raise Asked

    monkeypatch.setattr(models, "search_grids", searched)
    model_queries._eliminated.clear()

    def wanted(name):
        seen.clear()
        with pytest.raises(Asked):
            catalog.QUERIES[name](spark, "")
        return seen[0]

    assert wanted("grid_search") == ([("one", models.FOREST_GRID)], 5)
    regression = {"boost": models.BOOST_REG_GRID, "gbt": models.GBT_REG_GRID, "random_forest": models.FOREST_REG_GRID}
    assert wanted("reg_path1") == (list(regression.items()), 3)
    for name, family in (("reg_random_forest", "random_forest"), ("reg_gbt", "gbt"), ("reg_xgb", "boost")):
        assert wanted(name) == ([(family, regression[family])], 3)
    monkeypatch.setattr(models, "fit_logistic", lambda *a: None)
    monkeypatch.setattr(models, "fit_svm_grid", lambda *a: None)
    assert wanted("train_classifiers") == ([("boost", models.BOOST_GRID), ("gbt", models.GBT_GRID), ("random_forest", models.FOREST_GRID)], 5)
    monkeypatch.undo()
    monkeypatch.setattr(model_queries, "study", lambda spark, sf: (rows, rows))
    monkeypatch.setattr(models, "LogisticRegression", asked("logistic", "maxIter"))
    assert wanted("clf_logistic") == ("logistic", 1000)
    monkeypatch.setattr(models, "boosted", asked("boosted", 0, 1))
    assert wanted("clf_gbt") == ("boosted", 200, 4) and wanted("clf_xgb") == ("boosted", 200, 6)
    monkeypatch.undo()
    monkeypatch.setattr(model_queries, "study", lambda spark, sf: (rows, rows))
    monkeypatch.setattr(models, "RandomForestClassifier", asked("trees", "numTrees", "maxDepth"))
    for name in ("clf_random_forest", "rfecv", "rfe_rank_top", "cross_val_predict", "ensemble_stacked", "model_complexity",
                 "permutation_importance", "tree_shap_importance", "rf_on_smote", "feature_importance_topk"):
        assert wanted(name) == ("trees", 300, 20), name
    monkeypatch.setattr(models, "fourier_features", asked("kernel", 3))
    assert wanted("clf_svm_rbf") == wanted("svm_grid") == ("kernel", 256)
    monkeypatch.setattr(models, "fit_svm_grid", asked("svm", 4, 5))
    monkeypatch.setattr(models, "fit_logistic", lambda *a: None)
    assert wanted("train_classifiers") == ("svm", models.SVM_GRID, 5)
    monkeypatch.setattr(models, "MultilayerPerceptronClassifier", asked("perceptron", "layers", "maxIter"))
    monkeypatch.setattr(model_queries.V, "clean", lambda spark, sf: rows.select(
        "sample_id", F.col("label").alias("NLOS"), F.array(F.lit(1.0), F.lit(2.0)).alias("cir"), *[F.col("path_id").cast("double").alias(c) for c in model_queries.S.SCALARS]))
    assert wanted("clf_waveform_nn") == ("perceptron", [32 + len(model_queries.S.SCALARS), 32, 16, 2], 100)


def test_trees_of_a_forest_grow_side_by_side(data, monkeypatch):
    train, test = data
    est, fits = models.forest(10, 5), []
    plain = type(est).fit
    monkeypatch.setattr(type(est), "fit", lambda self, df: fits.append((self.getNumTrees(), self.getSeed())) or plain(self, df))
    monkeypatch.setattr(models, "FIT_TREES", 4)
    fit = models.fit_forest(train, X, trees=10, depth=5)
    assert sorted(n for n, _ in fits) == [2, 4, 4] and len({seed for _, seed in fits}) == 3
    assert len(fit.model.trees) == fit.model.getNumTrees == 10 and fit.model.totalNumNodes == sum(t.numNodes for t in fit.model.trees)
    assert accuracy(fit, test)["auc"] > 0.85
    row = test.limit(1)
    votes = [t.transform(models.assemble(row, X)).first()["probability"][1] for t in fit.model.trees]
    assert fit.score(row).first()["prob"] == pytest.approx(np.mean(votes))


def test_permuted_rows_are_scored_once(data):
    train, test = data
    fit = models.fit_forest(train, X, trees=3, depth=3)
    plain, parts = fit.score, []
    fit.score = lambda df: parts.append(df.rdd.getNumPartitions()) or plain(df)
    out = explain.permutation_importance(fit, test, "id")
    assert parts == [int(test.sparkSession.conf.get("spark.sql.shuffle.partitions"))]
    assert "UDF" not in out._jdf.queryExecution().optimizedPlan().toString() and out.count() == 3


def test_shapley_values_come_from_bundles_of_trees_and_chunks_of_rows(data, monkeypatch):
    train, test = data
    fit = models.fit_forest(train, X, trees=5, depth=4)
    whole = {r["id"]: list(r["shap"]) for r in explain.tree_shap(test, fit).collect()}
    monkeypatch.setattr(explain, "TREES_PER_TASK", 2)
    monkeypatch.setattr(explain, "ROWS_PER_TASK", 20)
    parts = {r["id"]: list(r["shap"]) for r in explain.tree_shap(test, fit).collect()}
    assert set(parts) == set(whole) and all(parts[i] == pytest.approx(whole[i]) for i in whole)


def test_fits_have_few_tasks_and_trees_stay_with_the_rows(spark, data):
    assert [models.fit_tasks(n) for n in (0, 9_999, 10_000, 119_999, 900_000, 2_400_000, 30_000_000)] == [1, 1, 2, 12, 12, 13, 151]
    rows = spark.range(130_000, numPartitions=30)  # 14 tasks at 10,000 rows each
    assert models.dealt(rows).rdd.getNumPartitions() == 12
    assert models.forest().getCacheNodeIds()
    train, test = data
    fit = models.fit_forest(train, X, trees=5, depth=12)
    plain = models._vector_fit("plain", models.forest(5, 12).setCacheNodeIds(False), train, X, "label", "balanced_weight")
    assert fit.model.toDebugString.split("\n")[1:] == plain.model.toDebugString.split("\n")[1:]
