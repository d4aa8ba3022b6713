"""Nothing is lost or multiplied: odd file names, headers, labels, keys, ids, waves and probabilities."""

import collections
import os

import pytest
from pyspark.sql import functions as F

from test_sources import N, write
from wavelattice.functions.wavescan import find_peaks, scan_wave
from wavelattice.operators import metrics, profiling, quantiles, splits
from wavelattice.sources import measurements as M


def test_odd_file_and_folder_names_keep_their_rows(spark, tmp_path):
    src = str(tmp_path / "in put+%41")
    names = ["b+c.csv", "a.csv", "d e.csv", "f%20g.csv", "é.csv"]
    for i, name in enumerate(names):
        write(src, name, range(i * 100, i * 100 + 10 + i))
    sizes = {r["ENV_ID"]: r["count"] for r in M.load_dataset(spark, src, N).groupBy("ENV_ID").count().collect()}
    assert sizes == {i: 10 + names.index(name) for i, name in enumerate(sorted(names))}
    assert M.load_recursive(spark, src, N).count() == 60
    M.ingest_csv(spark, src, str(tmp_path / "out"), N)
    assert sorted(r["sample_id"] for r in M.read_measurements(spark, str(tmp_path / "out")).select("sample_id").collect()) == list(range(60))


def test_foreign_headers_and_broken_lines_are_refused(spark, tmp_path):
    src = str(tmp_path / "swapped")
    write(src, "a.csv", range(5))
    path = os.path.join(src, "a.csv")
    text = open(path).read()
    open(path, "w").write(text.replace("RANGE", "_").replace("CIR_PWR", "RANGE").replace("_,", "CIR_PWR,", 1))
    with pytest.raises(Exception, match="(?i)header"):
        M.load_dataset(spark, src, N).collect()
    broken = str(tmp_path / "broken")
    write(broken, "a.csv", range(5))
    with open(os.path.join(broken, "a.csv"), "a") as f:
        f.write("not,a,number\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        M.load_dataset(spark, broken, N).collect()


def test_null_labels_and_repeated_keys(spark):
    rows = [(i, None if i % 4 == 0 else i % 2) for i in range(40)] + [(7, 1), (7, 1), (None, 0), (None, None)]
    df = spark.createDataFrame(rows, "id bigint, label int")
    for out in (splits.stratified_folds(df, "id", "label", 5), splits.stratified_split(df, "id", "label"),
                splits.stratified_folds(df, "id", None, 3), profiling.attach_weights(df, "label"), splits.contiguous_folds(df, "id", 3)):
        got = collections.Counter((r["id"], r["label"]) for r in out.collect())
        assert got == collections.Counter(rows)
    folds = splits.stratified_folds(df, "id", "label", 5).collect()
    assert len({r["fold"] for r in folds if r["id"] == 7}) == 1
    per = collections.Counter(r["fold"] for r in folds if r["label"] is None and r["id"] is not None)
    assert max(per.values()) - min(per.get(i, 0) for i in range(5)) <= 1
    test = [r for r in splits.stratified_split(df, "id", "label").collect() if r["split"] == "test"]
    assert sum(r["label"] is None for r in test) >= 2


def test_running_sums_order_large_integers(spark):
    ids = [2 ** 60 + i for i in (3, 0, 5, 1, 4, 2)]
    df = spark.createDataFrame([(i, 1) for i in ids], "id bigint, one int")
    up = {r["id"] - 2 ** 60: r["cum_one"] for r in quantiles.prefix_sums(df, [], "id", ["one"]).collect()}
    down = {r["id"] - 2 ** 60: r["cum_one"] for r in quantiles.prefix_sums(df, [], "id", ["one"], descending=True).collect()}
    assert up == {i: i + 1 for i in range(6)} and down == {i: 6 - i for i in range(6)}


def test_null_and_empty_waves(spark):
    wave = [0.0, 1.0, 0.0, 5.0, 0.0, 2.0, 0.0]
    df = spark.createDataFrame([(1, wave), (2, None), (3, []), (4, wave), (5, [3.0])], "id int, w array<double>").coalesce(1)
    found = {r["id"]: [p["idx"] for p in r["p"] or []] for r in df.select("id", find_peaks(F.col("w"), F.lit(0.5)).alias("p")).collect()}
    assert found == {1: [1, 3, 5], 2: [], 3: [], 4: [1, 3, 5], 5: []}
    scanned = {r["id"]: r["s"]["energy"] for r in df.select("id", scan_wave(F.col("w"), F.lit(3), F.lit(5.0)).alias("s")).collect()}
    assert scanned == {1: 30.0, 2: 0.0, 3: 0.0, 4: 30.0, 5: 9.0}


def test_null_probabilities_are_refused(spark):
    df = spark.createDataFrame([("m", 0.5, 1), ("m", None, 0), ("m", 0.1, 0)], "model string, prob double, label int")
    with pytest.raises(Exception, match="null probability of model m"):
        metrics.auc_trapezoid(df).collect()


def test_small_tables_are_broadcast_not_shuffled_on_few_keys(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select(F.lit("m").alias("model"), (F.col("id") / 1000).alias("prob"), (F.col("id") % 2).cast("int").alias("label"))
        for out in (metrics.roc_curve(df), profiling.histogram(df, ["prob"], "label")):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
