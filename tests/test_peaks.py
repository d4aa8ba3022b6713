"""Peak functions against hand-made waves and a direct reading of the peak definition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavelattice.functions import waves as W
from wavelattice.functions import wavescan as P


def naive_peaks(x, height, distance, prominence):
    """Peaks by definition, one wave, plain loops."""
    peaks, i = [], 1
    while i < len(x) - 1:
        if x[i - 1] < x[i]:
            j = i
            while j + 1 < len(x) and x[j + 1] == x[i]:
                j += 1
            if j + 1 < len(x) and x[j + 1] < x[i]:
                peaks.append((i + j) // 2)
            i = j + 1
        else:
            i += 1
    peaks = [p for p in peaks if x[p] >= height]
    kept = []
    for p in sorted(peaks, key=lambda p: (-x[p], -p)):
        if all(abs(p - q) >= distance for q in kept):
            kept.append(p)
    out = []
    for p in sorted(kept):
        lows = []
        for step in (-1, 1):
            i, low = p, x[p]
            while 0 <= i < len(x) and x[i] <= x[p]:
                low = min(low, x[i])
                i += step
            lows.append(low)
        prom = x[p] - max(lows)
        if prom >= prominence:
            out.append((p, prom))
    return out


@pytest.mark.parametrize("levels", [0, 3, 6, 20])
def test_peaks_equal_the_definition_on_random_waves(levels):
    rng = np.random.default_rng(levels)
    waves = rng.random((60, 97))
    if levels:
        waves = np.floor(waves * levels)  # plateaus and equal heights
    height, prom = rng.random(60) * (levels or 1) * 0.5, rng.random(60) * (levels or 1) * 0.3
    for distance in (1, 2, 5, 15, 40):
        row, pos, prominence = P.peaks_of(waves, height, distance, prom)
        for r in range(len(waves)):
            mine = list(zip(pos[row == r], prominence[row == r]))
            assert mine == naive_peaks(waves[r], height[r], distance, prom[r]), (r, distance)


def bump(n, *tops):
    x = np.zeros(n)
    for at, h, half in tops:
        for d in range(-half, half + 1):
            if 0 <= at + d < n:
                x[at + d] = max(x[at + d], h * (1 - abs(d) / (half + 1)))
    return x


def second(wave, idx1):
    i, a = P.second_paths(wave[None, :], np.array([idx1]), np.array([wave[idx1]]))
    return int(i[0]), float(a[0])


def test_single_peak_has_no_second_path():
    assert second(bump(64, (20, 10.0, 4)), 20) == (0, 0.0)


def test_second_path_is_the_most_prominent_not_the_highest():
    x = bump(200, (20, 10.0, 6), (120, 4.0, 6))
    x[23:100] = np.maximum(x[23:100], 5.0)
    x[80] = 6.0   # higher, but on a shelf of the first peak
    assert second(x, 20)[0] == 120


@pytest.mark.parametrize("gap,found", [(15, False), (16, True)])
def test_exclusion_zone(gap, found):
    x = bump(80, (20, 10.0, 2), (20 + gap, 5.0, 2))
    assert (second(x, 20)[1] > 0) == found


@pytest.mark.parametrize("gap,kept", [(14, 1), (15, 2)])
def test_minimum_distance(gap, kept):
    x = bump(90, (40, 5.0, 3), (40 + gap, 4.0, 3))
    row, pos, _ = P.peaks_of(x[None, :], np.array([0.1]), 15, np.array([0.1]))
    assert len(pos) == kept and pos[0] == 40


def test_plateau_and_ends():
    x = np.array([9.0, 1, 2, 5, 5, 5, 5, 2, 8])
    row, pos = P.row_maxima(x[None, :])
    assert list(pos) == [4]


def test_smoothing_pads_with_zeros():
    assert P.smooth3(np.array([[3.0, 3.0, 3.0]]))[0] == pytest.approx([2.0, 3.0, 2.0])


def test_expressions_agree_with_batch(spark):
    rng = np.random.default_rng(3)
    waves = np.floor(rng.random((40, 60)) * 8)
    df = spark.createDataFrame([(i, [float(v) for v in w]) for i, w in enumerate(waves)], "id long, w array<double>")
    got = {r["id"]: r for r in df.select("id", W.local_maxima(F.col("w")).alias("m"),
                                         W.moving_average3(F.col("w")).alias("s")).collect()}
    row, pos = P.row_maxima(waves)
    for i in range(40):
        assert got[i]["m"] == list(pos[row == i])
        assert got[i]["s"] == list(P.smooth3(waves)[i])
    found = df.select("id", P.find_peaks(F.col("w"), F.lit(2.0), 5, F.lit(1.0)).alias("p")).collect()
    for r in found:
        assert [(p["idx"], p["prominence"]) for p in r["p"]] == naive_peaks(waves[r["id"]], 2.0, 5, 1.0)
