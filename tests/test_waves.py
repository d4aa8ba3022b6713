import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavelattice import schema as S
from wavelattice.functions import waves as W
from wavelattice.operators import paths
from wavelattice.operators.cleaning import drop_degenerate, normalize_wave
from wavelattice.plans import views as V

SF = "/root/testdata/sf0.001"


def one(spark, values, expr):
    df = spark.createDataFrame([([float(v) for v in values],)], "w array<double>")
    return df.select(expr(F.col("w")).alias("v")).first()["v"]


def test_argmax_takes_the_first_maximum(spark):
    p = one(spark, [0, 1, 7, 3, 7, 0], lambda w: W.argmax_near(w, F.lit(3), 2))
    assert (p["idx"], p["amp"]) == (2, 7.0)


def test_argmax_beyond_the_end_keeps_the_centre(spark):
    p = one(spark, [1, 2, 3], lambda w: W.argmax_near(w, F.lit(40), 10))
    assert (p["idx"], p["amp"]) == (40, 3.0)


def test_edges_stop_at_the_window_and_at_a_tenth(spark):
    wave = [5, 6, 10, 9, 0.5, 9, 9]
    assert one(spark, wave, lambda w: W.rise_time(w, F.lit(2), F.lit(10.0))) == 3.0
    assert one(spark, wave, lambda w: W.decay_time(w, F.lit(2), F.lit(10.0))) == 2.0
    flat = [10.0] * 60
    assert one(spark, flat, lambda w: W.rise_time(w, F.lit(30), F.lit(10.0))) == 16.0
    assert one(spark, flat, lambda w: W.decay_time(w, F.lit(30), F.lit(10.0))) == 16.0
    assert one(spark, flat, lambda w: W.rise_time(w, F.lit(2), F.lit(10.0))) == 3.0


def test_zero_and_constant_waves(spark):
    assert one(spark, [0] * 8, W.mean_excess_delay) == 0.0
    assert one(spark, [0] * 8, W.rms_delay_spread) == 0.0
    assert one(spark, [0] * 8, W.max_to_mean) == 0.0
    assert one(spark, [3] * 8, W.excess_kurtosis) == 0.0
    assert one(spark, [0] * 8, lambda w: W.tail_energy_ratio(w, F.lit(3))) == 0.0


def test_tail_energy_clips_the_index(spark):
    assert one(spark, [1, 1, 1, 1], lambda w: W.tail_energy_ratio(w, F.lit(0))) == 1.0
    assert one(spark, [1, 1, 1, 1], lambda w: W.tail_energy_ratio(w, F.lit(99))) == 0.25


def test_moments(spark):
    x = np.random.default_rng(0).random(50)
    k = np.arange(50)
    mean = (x ** 2 @ k) / (x ** 2).sum()
    assert one(spark, x, W.mean_excess_delay) == pytest.approx(mean)
    assert one(spark, x, W.rms_delay_spread) == pytest.approx(math.sqrt((x ** 2 @ (k - mean) ** 2) / (x ** 2).sum()))
    c = x - x.mean()
    assert one(spark, x, W.excess_kurtosis) == pytest.approx((c ** 4).mean() / (c ** 2).mean() ** 2 - 3)


def test_resampling_and_shifting(spark):
    x = np.random.default_rng(1).random(9)
    want = np.interp(np.linspace(0, 1, 31), np.linspace(0, 1, 9), x)
    assert one(spark, x, lambda w: W.resample_linear(w, 31)) == pytest.approx(list(want))
    assert one(spark, [1, 2, 3], lambda w: W.shift_zero_fill(w, F.lit(1))) == [0, 1, 2]
    assert one(spark, [1, 2, 3], lambda w: W.shift_zero_fill(w, F.lit(-2))) == [3, 0, 0]
    assert one(spark, [1, 2, 3], lambda w: W.shift_zero_fill(w, F.lit(5))) == [0, 0, 0]


def test_normalising_replaces_what_is_not_finite(spark):
    values = [1.0, float("nan"), float("inf"), float("-inf"), -4.0]
    assert one(spark, values, lambda w: W.normalized(w, F.lit(2.0))) == [0.5, 0, 0, 0, -2.0]
    assert one(spark, values, lambda w: W.normalized(w, F.lit(0.0))) == [0.0] * 5
    assert one(spark, values, W.finite_or_zero) == [1.0, 0, 0, 0, -4.0]


def rows(df):
    return {(r["sample_id"], r["path_id"]): r for r in df.collect()}


def test_fused_features_equal_the_stepwise_ones_and_ignore_partitioning(spark):
    raw = drop_degenerate(V.sig(spark, SF))
    fused = rows(paths.measurement_features(raw.repartition(7)))
    clean = normalize_wave(raw).coalesce(1)
    step = rows(paths.expand_two_paths(paths.with_paths(clean)))
    assert fused.keys() == step.keys() and len(fused) == 2 * raw.count()
    for k, r in fused.items():
        for c in ["label", "range_m", *S.FEATURES]:
            assert r[c] == pytest.approx(step[k][c], abs=1e-9), (k, c)


def test_batch_statistics_equal_the_expressions(spark):
    clean = normalize_wave(drop_degenerate(V.sig(spark, SF)))
    located = paths.with_paths(clean)
    w = F.col("cir")
    got = located.select("scan.*", W.energy(w).alias("e"), W.mean_excess_delay(w).alias("m"),
                         W.rms_delay_spread(w).alias("r"), W.excess_kurtosis(w).alias("k"), W.max_to_mean(w).alias("x"),
                         W.tail_energy_ratio(w, F.col("path1.idx")).alias("t1"),
                         W.tail_energy_ratio(w, F.col("path2.idx")).alias("t2")).collect()
    for r in got:
        assert [r[c] for c in ("energy", "mean_excess_delay", "rms_delay_spread", "kurtosis_full", "max_to_mean",
                               "tail1", "tail2")] == pytest.approx([r[c] for c in "e m r k x t1 t2".split()])


def test_undetected_second_path_keeps_the_wave_wide_values(spark):
    f = paths.measurement_features(drop_degenerate(V.sig(spark, SF)))
    missing = f.filter((F.col("path_id") == 2) & (F.col("p_path_amp") == 0)).collect()
    first = rows(f.filter("path_id = 1"))
    assert missing
    for r in missing:
        assert r["label"] == 1 and r["p_path_idx"] == 0 and r["p_rise_time"] == 0 and r["p_energy_ratio"] == 0
        assert r["p_tail_energy_ratio"] == pytest.approx(1.0)
        assert r["path_delay_separation"] == -first[(r["sample_id"], 1)]["p_path_idx"]
        assert r["p_kurtosis_full"] == first[(r["sample_id"], 1)]["p_kurtosis_full"]


def test_path_labels(spark):
    f = paths.measurement_features(drop_degenerate(V.sig(spark, SF)))
    assert f.filter((F.col("path_id") == 2) & (F.col("label") != 1)).isEmpty()
    assert paths.valid_second_paths(f).filter("p_path_amp <= 0").isEmpty()
