"""Descriptive tables over labelled scalar columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wavelattice.operators.quantiles import exact_quantiles

EXPRESSION_COLUMNS = 24


def dataset_profile(df: DataFrame, label: str = "NLOS", env: str = "ENV_ID") -> DataFrame:
    """Row count, class counts, number of environments and the largest environment id."""
    return df.agg(F.count("*").alias("n_rows"), F.count_if(F.col(label) == 0).alias("n_los"),
                  F.count_if(F.col(label) == 1).alias("n_nlos"),
                  F.countDistinct(env).alias("n_envs"), F.max(env).alias("max_env"))


def class_distribution(df: DataFrame, label: str, stage: str) -> DataFrame:
    """``stage, label, n``."""
    return (df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count("*").alias("n"))
            .select(F.lit(stage).alias("stage"), "label", "n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: size, the balanced weight, the mean-one boosting weight and the negative/positive ratio.

    The result has one row per class. The boosting weight gives class 0 the weight ``n1/n0`` and
    class 1 the weight 1, divided by the mean weight over all rows.
    """
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n_class"))
    stats = counts.agg(F.sum("n_class").alias("n"), F.count("*").alias("k"),
                       F.sum(F.when(F.col("label") == 0, F.col("n_class")).otherwise(0)).alias("n0"),
                       F.sum(F.when(F.col("label") == 1, F.col("n_class")).otherwise(0)).alias("n1"))
    # class 0 is scaled by n1 / n0; a missing positive class counts as one row
    ratio = F.try_divide(F.col("n0"), F.greatest(F.col("n1"), F.lit(1)))
    raw0 = F.try_divide(F.lit(1.0), ratio)
    mean = (F.coalesce(raw0, F.lit(0.0)) * F.col("n0") + F.col("n1")) / F.col("n")
    raw = F.when(F.col("label") == 0, raw0).otherwise(F.lit(1.0))
    return counts.join(F.broadcast(stats)).select(
        "label", "n_class", (F.col("n") / (F.col("k") * F.col("n_class"))).alias("balanced_weight"),
        (raw / mean).alias("boost_weight"), ratio.alias("scale_pos_weight"))


def attach_weights(df: DataFrame, label: str, kind: str = "balanced_weight",
                   name: str = "weight") -> DataFrame:
    """Add the class weight of every row; the weight table has one row per class.

    ``pos_weight`` gives class 1 the negative/positive ratio and the others 1.
    """
    value = F.col(kind) if kind != "pos_weight" else F.when(F.col("label") == 1, F.col("scale_pos_weight")).otherwise(1.0)
    weights = class_weights(df, label).select(F.col("label").alias("_wl"), value.alias(name))
    return df.join(F.broadcast(weights), F.col(label).eqNullSafe(F.col("_wl"))).drop("_wl")


def _matrix_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`centred_moments` with one matrix product per batch; a pair is averaged over rows where both are there."""
    src = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    first = src.agg(*[F.avg(c).alias(c) for c in src.columns]).first()
    means = np.array([0.0 if x is None else x for x in first])
    a, b = np.triu_indices(len(columns))

    def run(batches):
        total, n = np.zeros((len(means),) * 2), np.zeros((len(means),) * 2)
        for batch in batches:
            there = np.stack([~np.asarray(pc.is_null(c)) for c in batch.columns], axis=1).astype(float)
            x = np.stack([np.asarray(pc.fill_null(c, 0.0)) for c in batch.columns], axis=1)
            x = np.where(there > 0, x - means, 0.0)
            total += x.T @ x
            n += there.T @ there
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total[a, b]), pa.array(n[a, b])],
                                         names=["i", "j", "total", "n"])

    sums = src.mapInArrow(run, "i int, j int, total double, n double").groupBy("i", "j").agg(
        F.try_divide(F.sum("total"), F.sum("n")).alias("cov"))
    names = F.array(*map(F.lit, columns))
    return sums.select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), "cov")


def centred_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population covariance of all column pairs as ``a, b, cov`` (``a`` before or equal to ``b``).

    Two passes: means first, then sums of centred products. All pairs are sums in one aggregate,
    so each task ships a single row; beyond ``EXPRESSION_COLUMNS`` columns that aggregate would have too many expressions
    to compile, and each task multiplies its rows as a matrix instead.
    """
    columns = list(columns)
    if len(columns) > EXPRESSION_COLUMNS:
        return _matrix_moments(df, columns)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"_m_{c}") for c in columns])
    centred = df.join(F.broadcast(means)).select(  # exactly one row of means
        *[(F.col(c).cast("double") - F.col(f"_m_{c}")).alias(c) for c in columns])
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = centred.agg(*[F.avg(F.col(columns[i]) * F.col(columns[j])).alias(f"{i}_{j}") for i, j in pairs])
    rows = F.array(*[F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"),
                              F.col(f"{i}_{j}").alias("cov")) for i, j in pairs])
    return sums.select(F.inline(rows))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, both triangles, as ``a, b, r``."""
    cov = centred_moments(df, columns)
    lookup = (cov.filter(F.col("a") == F.col("b")).agg(
        F.map_from_entries(F.collect_list(F.struct("a", F.sqrt("cov")))).alias("sd")))
    r = cov.join(F.broadcast(lookup)).select(  # one row of standard deviations
        "a", "b", F.try_divide(F.col("cov"), F.col("sd")[F.col("a")] * F.col("sd")[F.col("b")]).alias("r"))
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", "r"))).otherwise(
        F.array(F.struct("a", "b", "r"),
                F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("r").alias("r"))))
    return r.select(F.inline(both))


def _long(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    doubles = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(keys), list(columns), "variable", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value"))


def histogram(df: DataFrame, columns: Sequence[str], group: str | None = None, bins: int = 50) -> DataFrame:
    """Equal-width histogram per variable and class: bin, edges, count and density.

    The range is that of the class's own rows; every bin is closed on the left, the last on both
    sides. Only non-empty bins are listed. The ranges are one row per (variable, class).
    """
    keys = [group] if group else []
    long = _long(df, keys, columns)
    by = ["variable", *keys]
    limits = long.groupBy(*[F.col(k).alias(f"_l_{k}") for k in by]).agg(
        F.min("value").alias("lo0"), F.max("value").alias("hi0"), F.count("*").alias("n_all"))
    flat = F.col("lo0") == F.col("hi0")
    limits = limits.select(*[f"_l_{k}" for k in by], "n_all",
                           F.when(flat, F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                           F.when(flat, F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    on = F.lit(True)
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"_l_{k}"))
    step = (F.col("hi") - F.col("lo")) / bins
    guess = F.least(F.floor((F.col("value") - F.col("lo")) / step), F.lit(bins - 1))
    # floor of a quotient can be off by one at an edge: compare with the edges themselves
    fixed = (F.when(F.col("value") < F.col("lo") + F.col("g") * step, F.col("g") - 1)
             .when((F.col("value") >= F.col("lo") + (F.col("g") + 1) * step) & (F.col("g") < bins - 1),
                   F.col("g") + 1).otherwise(F.col("g")))
    # the limits are one row per variable and class
    counted = (long.join(F.broadcast(limits), on).withColumn("g", guess).withColumn("bin", fixed.cast("int"))
               .groupBy(*by, "bin", "lo", "hi", "n_all").agg(F.count("*").alias("n")))
    return counted.select(*by, "bin", (F.col("lo") + F.col("bin") * step).alias("left_edge"), "n",
                          (F.col("n") / (F.col("n_all") * step)).alias("density"))


def equal_width_bin(value, lo, hi, bins: int):
    """Index 0..bins-1 of right-closed equal bins over ``[lo, hi]``; the minimum is in bin 0."""
    step = (hi - lo) / bins
    guess = F.greatest(F.ceil(F.try_divide(value - lo, step)) - 1, F.lit(0))
    guess = F.least(F.coalesce(guess, F.lit(0)), F.lit(bins - 1))
    above = (value > lo + (guess + 1) * step) & (guess < bins - 1)
    below = (value <= lo + guess * step) & (guess > 0)
    return F.when(above, guess + 1).when(below, guess - 1).otherwise(guess).cast("int")


def equal_width_cut(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
                    bins: int = 10) -> DataFrame:
    """Rows per right-closed equal-width bin, in long form: ``variable, value, bin, left, right``.

    The lowest edge is lowered by 0.1 % of the range, as interval labels show it.
    """
    long = _long(df, keys, columns)
    limits = long.groupBy(F.col("variable").alias("_v")).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / bins
    # one row of limits per variable
    binned = long.join(F.broadcast(limits), F.col("variable") == F.col("_v")).withColumn(
        "bin", equal_width_bin(F.col("value"), F.col("lo"), F.col("hi"), bins))
    left = F.when(F.col("bin") == 0, F.col("lo") - 0.001 * (F.col("hi") - F.col("lo"))).otherwise(
        F.col("lo") + F.col("bin") * step)
    return binned.select("variable", *keys, "value", "bin", left.alias("bin_left"),
                         (F.col("lo") + (F.col("bin") + 1) * step).alias("bin_right"))


def error_by_bin(df: DataFrame, columns: Sequence[str], correct: str, bins: int = 10) -> DataFrame:
    """Error rate and row count per observed bin of each variable; one shuffle for all variables."""
    cut = equal_width_cut(df, columns, [correct], bins)
    return (cut.groupBy("variable", "bin", "bin_left", "bin_right")
            .agg((1.0 - F.avg(correct)).alias("error_rate"), F.count("*").alias("n"))
            .select("variable", "bin", ((F.col("bin_left") + F.col("bin_right")) / 2).alias("bin_mid"),
                    "error_rate", "n"))


def iqr_outliers(df: DataFrame, columns: Sequence[str], label: str, whisker: float = 1.5) -> DataFrame:
    """Tukey outliers per column: fences, count, share of rows and class-1 share among them.

    A last row, ``any``, counts the rows that are outliers in at least one column. Nulls and NaN are no outliers.
    """
    columns = list(columns)
    q = exact_quantiles(df, columns, [0.25, 0.75])
    fences = q.groupBy("column").agg(F.min("q_value").alias("q1"), F.max("q_value").alias("q3"))
    spread = F.col("q3") - F.col("q1")
    fences = fences.select("column", (F.col("q1") - whisker * spread).alias("low"),
                           (F.col("q3") + whisker * spread).alias("high"))
    # one struct per column, fixed by the arguments
    one = fences.groupBy().agg(F.map_from_entries(F.collect_list(
        F.struct("column", F.struct("low", "high")))).alias("_f"))
    joined = df.join(F.broadcast(one))

    def outside(c):
        f = F.col("_f")[c]
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))  # NaN is missing, not the largest number
        return F.coalesce((x < f["low"]) | (x > f["high"]), F.lit(False))

    flags = joined.select("_f", F.col(label).cast("int").alias("_y"),
                          *[outside(c).alias(c) for c in columns])
    anyone = F.lit(False)
    for c in columns:
        anyone = anyone | F.col(c)
    flags = flags.withColumn("any", anyone)
    measures = []
    for c in [*columns, "any"]:
        measures += [F.count_if(F.col(c)).alias(f"n_{c}"),
                     F.count_if(F.col(c) & (F.col("_y") == 1)).alias(f"p_{c}")]
    total = flags.agg(F.count("*").alias("n_rows"), F.first("_f").alias("_f"), *measures)
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"),
        (F.col("_f")[c]["low"] if c != "any" else F.lit(None).cast("double")).alias("low"),
        (F.col("_f")[c]["high"] if c != "any" else F.lit(None).cast("double")).alias("high"),
        F.col(f"n_{c}").alias("n_outliers"),
        (100.0 * F.col(f"n_{c}") / F.col("n_rows")).alias("pct_outliers"),
        F.try_divide(100.0 * F.col(f"p_{c}"), F.col(f"n_{c}")).alias("pct_positive"))
        for c in [*columns, "any"]])
    return total.select(F.inline(rows))


def first_per_class(df: DataFrame, label: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of every class; Spark limits each partition before the shuffle."""
    from pyspark.sql import Window
    w = Window.partitionBy(label).orderBy(order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
