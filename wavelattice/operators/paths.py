"""From cleaned waves to two labelled feature rows per measurement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wavelattice import schema as S
from wavelattice.functions import waves as W
from wavelattice.functions.scalars import zero_guarded_ratio
from wavelattice.functions.wavescan import scan_wave


def _scaling(divisor: str | None):
    return (lambda part: part) if divisor is None else (lambda part: W.normalized(part, F.col(divisor)))


def with_paths(df: DataFrame, wave: str = "cir", first_path: str = "FP_IDX", divisor: str | None = None) -> DataFrame:
    """Add ``path1``/``path2`` (``struct<idx, amp>``) and the wave-wide ``scan`` columns.

    With ``divisor`` the wave is still raw: windows and batches are normalised where they are used,
    and no normalised copy of the whole wave is built.
    """
    centre = F.col(first_path).cast("int")
    located = df.withColumn("path1", W.argmax_near(F.col(wave), centre, scaled=_scaling(divisor)))
    scan = scan_wave(F.col(wave), F.col("path1.idx"), F.col("path1.amp"), F.col(divisor) if divisor else None)
    return located.withColumn("scan", scan).withColumn("path2", F.struct(
        F.col("scan.path2_idx").alias("idx"), F.col("scan.path2_amp").alias("amp")))


def measurement_features(df: DataFrame, wave: str = "cir", keys: tuple[str, ...] = ("sample_id", "env_id"),
                         label: str = "NLOS", divisor: str | None = "RXPACC") -> DataFrame:
    """Both paths and all features of raw, non-degenerate measurements in one pass over the waves."""
    return expand_two_paths(with_paths(df, wave, divisor=divisor), wave, keys, label, divisor)


def detection_rate(df: DataFrame) -> DataFrame:
    """How many measurements have a second path, and their share in percent."""
    found = F.col("path2.amp") > 0
    return df.agg(F.count_if(found).alias("n_found"), F.count("*").alias("n_samples"),
                  (100.0 * F.avg(found.cast("double"))).alias("pct_found"))


def _path_struct(path_id: int, own: Column, other: Column, shape: Column, label: Column, range_m: Column,
                 tail: Column) -> Column:
    amp = own["amp"]
    seen = amp > 0

    def local(c: Column) -> Column:
        return F.when(seen, c).otherwise(F.lit(0.0))

    values = {
        "p_path_idx": own["idx"].cast("double"),
        "p_path_amp": amp,
        "p_rise_time": shape["rise"],
        "p_decay_time": shape["decay"],
        "p_kurtosis_local": shape["kurtosis"],
        "p_energy_ratio": zero_guarded_ratio(shape["energy"], F.col("scan.energy")),
        "p_peak_to_noise": local(zero_guarded_ratio(amp, F.col("STDEV_NOISE"))),
        "p_amplitude_ratio": local(zero_guarded_ratio(amp, other["amp"])),
        "p_tail_energy_ratio": tail,
    }
    return F.struct(F.lit(path_id).alias("path_id"), label.cast("int").alias("label"),
                    range_m.cast("double").alias("range_m"),
                    *[c.alias(name) for name, c in values.items()])


def expand_two_paths(df: DataFrame, wave: str = "cir", keys: tuple[str, ...] = ("sample_id", "env_id"),
                     label: str = "NLOS", divisor: str | None = None) -> DataFrame:
    """Two rows per measurement with 25 features, label and range; the wave is dropped.

    The first path keeps the measured label and range. The second is always obstructed; its range
    grows with its delay behind the reported first path. One projection and one explode: no
    shuffle, and key columns such as ``split`` travel along.
    """
    w, p1, p2 = F.col(wave), F.col("path1"), F.col("path2")
    scaled = _scaling(divisor)
    df = df.withColumns({"_s1": W.local_shape(w, p1["idx"], p1["amp"], scaled=scaled),
                         "_s2": W.local_shape(w, p2["idx"], p2["amp"], scaled=scaled)})
    far = F.col("RANGE") + (p2["idx"] - F.col("FP_IDX")) * F.lit(S.METRES_PER_SAMPLE)
    both = F.array(
        _path_struct(1, p1, p2, F.col("_s1"), F.col(label), F.col("RANGE"), F.col("scan.tail1")),
        _path_struct(2, p2, p1, F.col("_s2"), F.lit(1), far, F.col("scan.tail2")))
    shared = [F.col(c).cast("double").alias(c) for c in S.SHARED_SCALARS]
    derived = [
        (p2["idx"] - p1["idx"]).cast("double").alias("path_delay_separation"),
        (p1["idx"] - F.col("FP_IDX")).cast("double").alias("path1_to_fp_offset"),
        zero_guarded_ratio(F.col("FP_AMP1"), F.col("CIR_PWR")).alias("relative_power"),
    ]
    wide = ["rms_delay_spread", "mean_excess_delay", "kurtosis_full", "max_to_mean"]
    whole = [F.col(f"scan.{c}").alias(f"p_{c}") for c in wide]
    rows = df.select(*keys, F.col("RANGE").cast("double").alias("RANGE"), F.explode(both).alias("p"),
                     *whole, *shared, *derived)
    return rows.select(*keys, "RANGE", "p.*", *[f"p_{c}" for c in wide], *S.SHARED_SCALARS,
                       *S.DERIVED_FEATURES).select(*keys, "path_id", "label", "range_m", "RANGE",
                                                   *S.FEATURES)


def expansion_report(df: DataFrame) -> DataFrame:
    """Rows per label and undetected second paths of an expanded table, in one pass."""
    undetected = (F.col("path_id") == 2) & (F.col("p_path_amp") == 0)
    return df.agg(F.count("*").alias("n_rows"), F.count_if(F.col("label") == 0).alias("n_los"),
                  F.count_if(F.col("label") == 1).alias("n_nlos"),
                  F.count_if(undetected).alias("n_no_second_path"))


def valid_second_paths(features: DataFrame) -> DataFrame:
    """Second-path rows whose path was really detected (the regression subset)."""
    return features.filter((F.col("path_id") == 2) & (F.col("p_path_amp") > 0))
