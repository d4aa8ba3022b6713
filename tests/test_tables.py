"""Splits, quantiles, profiles and metrics, with one value or class holding much of the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavelattice.operators import cleaning, metrics, profiling, quantiles, splits


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; a third share one score and most belong to one class."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        score = 0.25 if i % 3 == 0 else round(float(rng.random()), 3)
        rows.append((i, int(rng.random() < 0.2), score, float(rng.normal())))
    return spark.createDataFrame(rows, "id long, label int, prob double, x double").cache()


def test_quantiles_equal_numpy(skewed):
    got = {(r["column"], r["prob"]): r["q_value"] for r in quantiles.exact_quantiles(
        skewed, ["prob", "x"], [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]).collect()}
    pdf = skewed.toPandas()
    for (c, p), v in got.items():
        assert v == pytest.approx(np.quantile(pdf[c], p)), (c, p)


def test_no_range_holds_much_more_than_its_share(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "RANGE_ROWS", 100)
    rows = spark.range(4000).select(F.when(F.col("id") < 3000, "big").when(F.col("id") < 3990, "mid").alias("k"),
                                    F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, 5), ("big", None, 3)], "k string, o long, v long"))
    for descending in (False, True):
        got = quantiles.prefix_sums(rows, ["k"], "o", ["v"], descending=descending)
        want = rows.toPandas().sort_values("o", ascending=not descending, na_position="first")
        want["cum_v"] = want.groupby("k", dropna=False)["v"].cumsum()
        key = lambda r: tuple(None if x != x else x for x in r)
        assert sorted(map(key, map(tuple, got.collect())), key=str) == sorted(map(key, want.itertuples(index=False)), key=str)
    parts = rows.repartitionByRange(1 + rows.count() // 100, "k", "o").groupBy(F.spark_partition_id()).count()
    assert parts.agg(F.max("count")).first()[0] <= 300


def test_prefix_sums_are_exact_for_any_cut(skewed):
    rows = skewed.groupBy("prob").agg(F.count("*").alias("n"))
    for ranges in (1, 7, 200):
        got = quantiles.prefix_sums(rows, [], "prob", ["n"], ranges=ranges).orderBy("prob").toPandas()
        assert list(got["cum_n"]) == list(got["n"].cumsum())


def test_split_quota_and_independence_of_partitions(spark, skewed):
    a = splits.stratified_split(skewed.repartition(1), "id", "label")
    b = splits.stratified_split(skewed.repartition(7), "id", "label")
    assert {tuple(r) for r in a.select("id", "split").collect()} == {tuple(r) for r in b.select("id", "split").collect()}
    sizes = {(r["label"], r["split"]): r["count"] for r in a.groupBy("label", "split").count().collect()}
    assert sizes[(0, "test")] + sizes[(1, "test")] == 600
    for y in (0, 1):
        n = sizes[(y, "test")] + sizes[(y, "train")]
        assert abs(sizes[(y, "test")] - 0.2 * n) < 1
    assert splits.split_check(a, "id", "label").filter("n_both > 0").isEmpty()


def test_folds_are_even_in_every_class(skewed):
    folded = splits.stratified_folds(skewed, "id", "label", 5)
    assert folded.count() == 3000
    for y in (0, 1):
        n = [r["count"] for r in folded.filter(F.col("label") == y).groupBy("fold").count().collect()]
        assert len(n) == 5 and max(n) - min(n) <= 1
    runs = splits.contiguous_folds(skewed.filter("id < 10"), "id", 3).orderBy("id").toPandas()
    assert list(runs["fold"]) == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_scaling_uses_train_rows_and_population_deviation(skewed):
    scaled = splits.scale_and_split(skewed.withColumn("flat", F.lit(4.0)), "id", "label", ["x", "flat"])
    r = scaled.filter("split = 'train'").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.max("flat").alias("f")).first()
    assert (r["m"], r["s"], r["f"]) == pytest.approx((0.0, 1.0, 0.0), abs=1e-9)


def test_sample_is_exact_and_repeatable(skewed):
    a = {r["id"] for r in splits.sampled_subset(skewed, "id", 100).collect()}
    assert len(a) == 100 and a == {r["id"] for r in splits.sampled_subset(skewed.repartition(5), "id", 100).collect()}


def test_auc_and_average_precision_with_ties(skewed):
    p = skewed.withColumn("model", F.lit("m")).withColumn("pred", (F.col("prob") >= 0.5).cast("int"))
    pdf = skewed.toPandas()
    pos, neg = pdf[pdf.label == 1].prob.to_numpy(), pdf[pdf.label == 0].prob.to_numpy()
    rank = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert metrics.auc_trapezoid(p).first()["auc"] == pytest.approx(rank)
    ap, last = 0.0, 0.0
    for t in sorted(pdf.prob.unique())[::-1]:
        hit = pdf[pdf.prob >= t]
        recall = hit.label.sum() / len(pos)
        ap, last = ap + (recall - last) * hit.label.mean(), recall
    assert metrics.average_precision(p).first()["ap"] == pytest.approx(ap)
    roc = metrics.roc_curve(p).orderBy("fpr", "tpr").toPandas()
    assert np.trapezoid(roc.tpr, roc.fpr) == pytest.approx(rank)


def test_undefined_ratios_count_as_zero(spark):
    p = spark.createDataFrame([("m", 0, 0.1, 0), ("m", 1, 0.2, 0)], "model string, label int, prob double, pred int")
    r = {x["row"]: x for x in metrics.classification_report(p).collect()}
    assert (r["1"]["precision"], r["1"]["recall"], r["1"]["f1"], r["1"]["support"]) == (0, 0, 0, 1)
    assert r["macro avg"]["f1"] == pytest.approx((2 / 3) / 2)


def test_histogram_and_cut_follow_numpy_and_pandas(skewed):
    import pandas as pd
    pdf = skewed.toPandas()
    h = profiling.histogram(skewed, ["x"], "label", 50).toPandas()
    for y in (0, 1):
        n, _ = np.histogram(pdf[pdf.label == y].x, bins=50)
        got = h[h.label == y].set_index("bin").n
        assert [got.get(i, 0) for i in range(50)] == list(n)
    cut = pd.cut(pdf.prob, 10, labels=False)
    mine = profiling.equal_width_cut(skewed, ["prob"], ["id"]).toPandas().set_index("id").bin
    assert (mine.sort_index().to_numpy() == cut.to_numpy()).all()


def test_correlations_and_covariances(skewed):
    pdf = skewed.toPandas()
    got = {(r["a"], r["b"]): r["r"] for r in profiling.corr_matrix(skewed, ["label", "prob", "x"]).collect()}
    want = pdf[["label", "prob", "x"]].corr()
    assert len(got) == 9
    for (a, b), v in got.items():
        assert v == pytest.approx(want.loc[a, b], abs=1e-9)


def test_imputation_handles_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 2), (float("nan"), None), (4.0, 4), (9.0, 9)], "a double, b int")
    assert {r["column"]: r["n_missing"] for r in cleaning.null_census(df).collect()} == {"a": 2, "b": 1}
    assert sorted(r["a"] for r in cleaning.median_impute(df, ["a", "b"]).collect()) == [1, 4, 4, 4, 9]


def test_mode_ties_take_the_smallest_value(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (2.0,), (1.0,), (3.0,)], "a double")
    r = cleaning.near_constant(df, ["a"]).first()
    assert (r["mode"], r["mode_pct"], r["near_constant"]) == (1.0, 40.0, 0)


def test_early_stop_and_learning_rate(spark):
    loss = [1.0, 0.5, 0.6, 0.6, 0.6, 0.4, 0.5, 0.5, 0.5, 0.5, 0.5, 0.1]
    df = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(loss)], "run string, epoch int, val_loss double")
    r = metrics.plateau_early_stop(df).first()
    assert (r["stop_epoch"], r["best_epoch"], r["best_loss"]) == (11, 6, 0.4)
    assert r["final_lr"] == pytest.approx(0.001 * 0.5 * 0.5)
