import time
import csv
import os

from pyspark.sql import functions as F

from wavelattice import schema as S
from wavelattice.operators.cleaning import preprocess
from wavelattice.operators.splits import scale_and_split
from wavelattice.sources import measurements as M
from wavelattice.sources.sinks import sink_table
from wavelattice.operators import models
from wavelattice.streaming.features import stream_features
from wavelattice.streaming.scoring import score_stream, stream_predictions

N = 24


def write(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    fields = S.raw_csv_schema(N).names
    with open(os.path.join(folder, name), "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(fields)
        for i in rows:
            wave = [(i * 7 + j * j) % 13 + (30 if j == 5 else 0) for j in range(N)]
            scalars = {"NLOS": i % 2, "FP_IDX": 5.5, "RXPACC": 10.0 + i % 3}
            out.writerow([scalars.get(c, 1.0 + (i + k) % 9) for k, c in enumerate(fields[:15])] + wave)


def test_files_become_environments_and_rows_get_stable_ids(spark, tmp_path):
    src = str(tmp_path / "in")
    write(src, "b.csv", range(100, 130))
    write(src, "a.csv", range(0, 20))
    write(os.path.join(src, "deep"), "c.csv", range(200, 210))
    df = M.load_dataset(spark, src, N)
    sizes = {r["ENV_ID"]: r["count"] for r in df.groupBy("ENV_ID").count().collect()}
    assert sizes == {0: 20, 1: 30}
    assert df.schema["cir"].dataType.elementType.simpleString() == "double"
    assert df.filter(F.col("cir")[5] < 30).isEmpty()
    assert M.load_recursive(spark, src, N).count() == 60
    M.ingest_csv(spark, src, str(tmp_path / "out"), N)
    rows = M.read_measurements(spark, str(tmp_path / "out")).orderBy("sample_id").collect()
    assert [r["sample_id"] for r in rows] == list(range(50))
    order = [*range(0, 20), *range(100, 130)]
    assert [r["cir"][0] for r in rows] == [float(i * 7 % 13) for i in order]
    assert [r["ENV_ID"] for r in rows] == [0] * 20 + [1] * 30


def test_numbered_columns_are_ordered_by_number():
    assert S.wave_columns(["CIR10", "CIR2", "CIR_PWR", "CIR1", "RANGE"]) == ["CIR1", "CIR2", "CIR10"]


def test_cleaning_splitting_and_streaming_chain(spark, tmp_path):
    src = str(tmp_path / "in")
    write(src, "a.csv", range(40))
    M.ingest_csv(spark, src, str(tmp_path / "m"), N)
    raw = M.read_measurements(spark, str(tmp_path / "m")).withColumnRenamed("ENV_ID", "env_id")
    clean = preprocess(raw)
    assert not set(clean.columns) & {"CH", "BITRATE", "PRFR"}
    split = scale_and_split(clean)
    assert split.filter("split = 'test'").count() == 8
    batch = {tuple(r) for r in stream_features(raw).collect()}
    table = str(tmp_path / "t")
    raw.write.parquet(table)
    live = stream_features(spark.readStream.schema(spark.read.parquet(table).schema).parquet(table))
    run = (live.writeStream.format("memory").queryName("live_features").outputMode("append")
           .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start())
    run.awaitTermination()
    assert {tuple(r) for r in spark.table("live_features").collect()} == batch and len(batch) == 80


def test_stream_scores_equal_batch_scores_after_a_restart(spark, tmp_path):
    src, table, out, state = (str(tmp_path / x) for x in ("in", "t", "scores", "state"))
    write(src, "a.csv", range(60))
    M.ingest_csv(spark, src, str(tmp_path / "m"), N)
    raw = M.read_measurements(spark, str(tmp_path / "m")).withColumnRenamed("ENV_ID", "env_id")
    rows = stream_features(raw).withColumn("label", (F.col("sample_id") % 3 == 0).cast("int"))
    fitted = models.fit_logistic(rows, ["p_path_idx", "p_energy_ratio"])
    keys = ["sample_id", "path_id"]
    want = {tuple(r) for r in stream_predictions(rows, fitted, keys).collect()}
    raw.filter("sample_id < 25").repartition(3).write.parquet(table)
    schema = spark.read.parquet(table).schema

    def scored():
        live = stream_features(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(table))
        return score_stream(live.withColumn("label", (F.col("sample_id") % 3 == 0).cast("int")), fitted, keys, out, state)

    scored().awaitTermination()
    raw.filter("sample_id >= 25").repartition(6).write.mode("append").parquet(table)
    half = scored()
    while not half.recentProgress and half.isActive:
        time.sleep(0.01)
    half.stop()  # in the middle of what has arrived since
    scored().awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(out).collect()]
    assert len(got) == len(want) == 120 and set(got) == want


def test_result_tables(spark, tmp_path):
    df = spark.range(5)
    assert spark.read.parquet(sink_table(df, str(tmp_path), "a")).count() == 5
    assert spark.read.option("header", True).csv(sink_table(df, str(tmp_path), "b", "csv")).count() == 5
