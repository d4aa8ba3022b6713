"""Cleaning of measurement tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wavelattice import schema as S
from wavelattice.functions import waves as W
from wavelattice.operators.quantiles import exact_quantiles


def _absent(name: str, dtype: str):
    c = F.col(name)
    return c.isNull() | F.isnan(c) if dtype in ("double", "float") else c.isNull()


def null_census(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values (null or NaN) per column, as ``column, n_missing``; one scan."""
    types = dict(df.dtypes)
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(_absent(c, types[c])).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "n_missing")


def median_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing values of numeric columns with the column's exact median.

    The medians are one row per column, so they join back as a single-row table.
    """
    types = dict(df.dtypes)
    medians = (exact_quantiles(df, columns, [0.5]).groupBy().pivot("column", list(columns))
               .agg(F.first("q_value")))
    renamed = medians.select(*[F.col(c).alias(f"_median_{c}") for c in columns])
    filled = df.join(F.broadcast(renamed))  # exactly one row
    for c in columns:
        filled = filled.withColumn(
            c, F.when(_absent(c, types[c]), F.col(f"_median_{c}")).otherwise(F.col(c).cast("double")))
    return filled.select(*df.columns)


def drop_degenerate(df: DataFrame, columns: Sequence[str] = tuple(S.DEGENERATE_IF_ZERO)) -> DataFrame:
    """Remove measurements in which any of the columns is exactly 0."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & ~F.coalesce(F.col(c) == 0, F.lit(False))
    return df.filter(keep)


def degenerate_report(df: DataFrame, columns: Sequence[str] = tuple(S.DEGENERATE_IF_ZERO)) -> DataFrame:
    """How many rows :func:`drop_degenerate` removes, in total and per column."""
    zero = [F.coalesce(F.col(c) == 0, F.lit(False)) for c in columns]
    anyone = F.lit(False)
    for z in zero:
        anyone = anyone | z
    return df.agg(F.count("*").alias("n_rows"), F.count_if(anyone).alias("n_removed"),
                  *[F.count_if(z).alias(f"n_zero_{c}") for c, z in zip(columns, zero)])


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, is_constant`` by comparing minimum and maximum; one scan."""
    flags = df.agg(*[F.coalesce((F.min(c) == F.max(c)).cast("int"), F.lit(1)).alias(c) for c in columns])
    return flags.unpivot([], list(columns), "column", "is_constant")


def drop_constant_columns(df: DataFrame, columns: Sequence[str] = tuple(S.CONSTANT_COLUMNS)) -> DataFrame:
    """Drop the columns known to carry no information; absent ones are ignored."""
    return df.drop(*columns)


def near_constant(df: DataFrame, columns: Sequence[str], threshold_pct: float = 90.0) -> DataFrame:
    """Most frequent value (smallest on ties) of each column, its share and a flag.

    All columns are counted by one shuffle; partial counts collapse dominant values map-side.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    counts = (doubles.unpivot([], list(columns), "column", "value").groupBy("column", "value")
              .agg(F.count("*").alias("n")))
    known = F.col("value").isNotNull()
    best = counts.groupBy("column").agg(
        F.max_by(F.when(known, F.col("value")), F.when(known, F.struct("n", -F.col("value")))).alias("mode"),
        F.max(F.when(known, F.col("n"))).alias("n_mode"), F.sum("n").alias("n_rows"))
    share = 100.0 * F.col("n_mode") / F.col("n_rows")
    return best.select("column", "mode", share.alias("mode_pct"),
                       (share > threshold_pct).cast("int").alias("near_constant"))


def normalize_wave(df: DataFrame, wave: str = "cir", divisor: str = "RXPACC") -> DataFrame:
    """Divide the wave by its accumulation count; anything not finite becomes 0."""
    return df.withColumn(wave, W.normalized(F.col(wave), F.col(divisor).cast("double")))


def nonfinite_report(df: DataFrame, wave: str = "cir") -> DataFrame:
    """Number of NaN and infinite samples in all waves."""
    counted = df.select(W.nonfinite_counts(F.col(wave)).alias("c"))
    return counted.agg(F.sum("c.nan").alias("n_nan"), F.sum("c.inf").alias("n_inf"))


def preprocess(df: DataFrame, wave: str = "cir") -> DataFrame:
    """The cleaning chain: impute, drop degenerate rows and constant columns, normalise.

    The median pass runs only when the one-scan census finds something to fill.
    """
    numeric = [c for c in S.SCALARS if c in df.columns]
    missing = null_census(df, numeric).agg(F.sum("n_missing")).first()[0]
    filled = median_impute(df, numeric) if missing else df
    kept = drop_constant_columns(drop_degenerate(filled), [c for c in S.CONSTANT_COLUMNS if c != "ENV_ID"])
    return normalize_wave(kept, wave)
