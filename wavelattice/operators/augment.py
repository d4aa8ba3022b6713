"""Oversampling and waveform augmentation with keyed randomness."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wavelattice import schema as S
from wavelattice.functions import waves as W
from wavelattice.functions.scalars import keyed_uniform
from wavelattice.operators.neighbors import knn
from wavelattice.operators.quantiles import prefix_sums
from wavelattice.session import cut_lineage


def _uniforms(keys: np.ndarray, n: int, stream: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from 64-bit mixing of (key, position): the same on every retry."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64)[:, None] + np.uint64(0x9E3779B97F4A7C15) * (
            np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(stream))[None, :]
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _noisy(waves: pa.Array, keys: pa.Array, level: pa.Array) -> pa.Array:
    values = waves.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(waves.offsets.to_numpy())
    starts = np.concatenate([[0], np.cumsum(sizes)])
    k = keys.to_numpy(zero_copy_only=False)
    lv = level.to_numpy(zero_copy_only=False)
    out = np.empty(len(values))
    at = 0
    while at < len(sizes):
        stop = min(at + 256, len(sizes))
        differ = np.nonzero(sizes[at:stop] != sizes[at])[0]
        stop = at + differ[0] if len(differ) else stop
        n = sizes[at]
        block = values[starts[at]:starts[stop]].reshape(stop - at, n)
        normal = (np.sqrt(-2.0 * np.log(_uniforms(k[at:stop], n, 0)))
                  * np.cos(2.0 * np.pi * _uniforms(k[at:stop], n, 1)))
        spread = np.maximum(block.std(axis=1), 1e-8) * lv[at:stop]
        out[starts[at]:starts[stop]] = (block + normal * spread[:, None]).ravel()
        at = stop
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(out))


def noise(wave: Column, key: Column, level: float | Column = 0.05, seed: int | Column = S.SEED) -> Column:
    """Gaussian noise scaled by the wave's own population deviation (at least 1e-8)."""
    level = level if isinstance(level, Column) else F.lit(float(level))
    seed = seed if isinstance(seed, Column) else F.lit(int(seed))
    return _noisy(wave, F.xxhash64(seed.cast("long"), key), level)


def jitter(wave: Column, key: Column, max_shift: int = 3, seed: int = S.SEED) -> Column:
    """Shift by a whole number of samples in ``-max_shift .. max_shift``; zeros move in."""
    shift = (F.floor(keyed_uniform(key, seed) * (2 * max_shift + 1)) - max_shift).cast("int")
    return W.bind(shift, lambda s: W.shift_zero_fill(wave, s))


def amplitude(wave: Column, key: Column, scale: tuple[float, float] = (0.8, 1.2), seed: int = S.SEED) -> Column:
    """Multiply the wave by one uniform factor."""
    factor = F.lit(scale[0]) + keyed_uniform(key, seed) * F.lit(scale[1] - scale[0])
    return F.zip_with(wave, F.array_repeat(factor, F.size(wave)), lambda x, f: x * f)


def augment_waveforms(df: DataFrame, key: str = "sample_id", wave: str = "cir", factor: int = 1,
                      noise_level: float = 0.05, max_shift: int = 2, scale: tuple[float, float] = (0.85, 1.15),
                      seed: int = S.SEED) -> DataFrame:
    """Original rows (``aug_round`` 0) and ``factor`` noisy, shifted, rescaled copies of each.

    Other columns are copied. Rounds differ by the key ``round|id``; no shuffle.
    """
    original = df.withColumn("aug_round", F.lit(0))
    if factor < 1:
        return original
    copies = df.withColumn("aug_round", F.explode(F.sequence(F.lit(1), F.lit(factor))))
    k = F.concat_ws("|", F.col("aug_round").cast("string"), F.col(key).cast("string"))
    w = noise(F.col(wave), k, noise_level, seed)
    noisy = copies.withColumn(wave, w)
    moved = noisy.withColumn(wave, jitter(F.col(wave), k, max_shift, seed + 1000))
    return original.unionByName(moved.withColumn(wave, amplitude(F.col(wave), k, scale, seed + 2000)))


def smote(df: DataFrame, key: str, columns: Sequence[str], label: str, target_ratio: float = 1.0, k: int = 5,
          seed: int = S.SEED) -> DataFrame:
    """Synthetic rows of the minority class: ``synth_id, base, neighbor, lam, <columns>, label``.

    ``max(0, int(majority * ratio) - minority)`` rows, each between a random minority row and one of
    its ``k`` nearest minority rows. Choices depend on (seed, synthetic number) only. A class tie
    makes the smaller label the minority.
    """
    columns = list(columns)
    counts = df.groupBy(label).count().collect()  # one row per class
    minority = min(counts, key=lambda r: (r["count"], r[label]))
    n_min, n_max = minority["count"], max(r["count"] for r in counts)
    n_new = max(0, int(n_max * target_ratio) - n_min)
    rows = df.filter(F.col(label) == minority[label]).select(
        F.col(key).cast("long").alias("_id"), F.array(*[F.col(c).cast("double") for c in columns]).alias("vec"))
    rows = cut_lineage(rows)
    near = cut_lineage(knn(rows, "_id", "vec", k).select(F.col("_id").alias("_nb_of"), "neighbor", "rank"))
    placed = prefix_sums(rows.select("_id", F.lit(1).alias("one")), [], "_id", ["one"]).select(
        (F.col("cum_one") - 1).alias("_pos"), F.col("_id").alias("base"))
    usable = min(k, n_min - 1)
    if n_new == 0 or usable < 1:
        n_new = 0
    i = F.col("id")
    draws = df.sparkSession.range(n_new).select(
        F.col("id").alias("synth_id"), F.floor(keyed_uniform(i, f"{seed}|base") * n_min).alias("_draw"),
        (F.floor(keyed_uniform(i, f"{seed}|near") * max(usable, 1)) + 1).alias("_rank"),
        keyed_uniform(i, f"{seed}|lam").alias("lam"))
    based = draws.join(placed, F.col("_draw") == F.col("_pos"))
    paired = based.join(near, (F.col("base") == F.col("_nb_of")) & (F.col("_rank") == F.col("rank")))
    a = rows.select(F.col("_id").alias("_a"), F.col("vec").alias("va"))
    b = rows.select(F.col("_id").alias("_b"), F.col("vec").alias("vb"))
    full = paired.join(a, F.col("base") == F.col("_a")).join(b, F.col("neighbor") == F.col("_b"))
    mixed = [(F.col("va")[j] + F.col("lam") * (F.col("vb")[j] - F.col("va")[j])).alias(c)
             for j, c in enumerate(columns)]
    return full.select("synth_id", "base", "neighbor", "lam", *mixed, F.lit(minority[label]).alias(label))


def with_smote(df: DataFrame, key: str, columns: Sequence[str], label: str, target_ratio: float = 1.0,
               k: int = 5, seed: int = S.SEED) -> DataFrame:
    """Original rows followed by the synthetic ones (``synthetic`` tells which)."""
    new = smote(df, key, columns, label, target_ratio, k, seed)
    return df.select(*columns, label, F.lit(0).alias("synthetic")).unionByName(
        new.select(*columns, label, F.lit(1).alias("synthetic")))
