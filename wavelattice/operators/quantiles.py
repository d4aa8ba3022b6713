"""Distributed prefix sums, and the exact ranks and quantiles built on them.

A running sum over one ordered group normally needs the whole group in one task. Here the rows are
range-partitioned, each range sums on its own, and the range totals
are prefix-summed to give every range its offset. Results are exact whatever the cut points are;
those only decide how evenly the work spreads.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wavelattice.session import cut_lineage, fresh_cut

RANGE_ROWS = 500_000  # aimed-at rows of a range
BROADCAST_OFFSETS = 50_000  # rows, one per range of a key, up to which the offsets are broadcast


def prefix_sums(df: DataFrame, keys: Sequence[str], order: str, measures: Sequence[str],
                descending: bool = False, ranges: int | None = None) -> DataFrame:
    """Add ``cum_<measure>``: the inclusive running sum per key in the order of one column.

    ``order`` must be distinct within each key (aggregate duplicates first), which also removes hot
    values. The rows are range-partitioned by keys and order into as many ranges as their number asks for; a key may lie
    across any number of ranges and a range may hold any number of keys.
    """
    keys = list(keys)
    kept = fresh_cut(df)
    if ranges is None:
        ranges = 1 + kept.count() // RANGE_ROWS
    exact = F.col(order).desc_nulls_first() if descending else F.col(order).asc_nulls_first()
    ranged = kept.repartitionByRange(ranges, *[F.col(k).asc_nulls_first() for k in keys], exact) if ranges > 1 else kept.coalesce(1)
    # kept, so that a range has the same rows whenever it is read
    ranged = fresh_cut(ranged.withColumn("_range", F.spark_partition_id()))
    totals = (ranged.groupBy(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col("_range").alias("_t_range"))
              .agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures]))
    before = (Window.partitionBy(*[f"_t_{k}" for k in keys]).orderBy("_t_range")
              .rowsBetween(Window.unboundedPreceding, -1))  # one row per range of a key
    offsets = totals.select(*[f"_t_{k}" for k in keys], "_t_range",
                            *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_off_{m}")
                              for m in measures])
    here = (Window.partitionBy(*keys, "_range").orderBy(exact)
            .rowsBetween(Window.unboundedPreceding, 0))
    inside = ranged.select(*df.columns, "_range",
                           *[F.sum(m).over(here).alias(f"_in_{m}") for m in measures])
    match = F.col("_range") == F.col("_t_range")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    offsets = fresh_cut(offsets)
    few = offsets.count() <= BROADCAST_OFFSETS
    return inside.join(F.broadcast(offsets) if few else offsets, match).select(
        *df.columns, *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"cum_{m}") for m in measures])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    accuracy: int = 10_000) -> DataFrame:
    """``column, prob, q_value``: exact, linearly interpolated quantiles without a global sort.

    Approximate quantiles bracket every wanted rank and the rows below each bracket are counted: two
    scans that return one row each. Only the values inside the brackets, about ``4 / accuracy`` of the
    rows and counted per distinct value, are shuffled and ordered.
    """
    valid = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    plain = df.select(*[v.alias(c) for c, v in valid.items()])
    margin = 2.0 / accuracy
    points = [x for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))]
    rough = plain.agg(*[F.percentile_approx(c, points, accuracy).alias(f"q{i}") for i, c in enumerate(columns)],
                      *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    asked = [(i, c, p, rough[f"q{i}"][2 * j], rough[f"q{i}"][2 * j + 1])
             for i, c in enumerate(columns) if rough[f"n{i}"] for j, p in enumerate(probs)]
    brackets = []
    if asked:
        counts = plain.agg(*[F.count_if(F.col(c) < lo).alias(f"b{k}") for k, (_, c, _, lo, _) in enumerate(asked)],
                           *[F.count_if(F.col(c) <= hi).alias(f"u{k}") for k, (_, c, _, _, hi) in enumerate(asked)]).first()
        for k, (i, c, p, lo, hi) in enumerate(asked):
            rank = p * (rough[f"n{i}"] - 1)
            if counts[f"b{k}"] <= rank and math.ceil(rank) < counts[f"u{k}"]:
                brackets.append((c, float(p), lo, hi, counts[f"b{k}"], rank))
            else:  # never narrower than the answer
                brackets.append((c, float(p), float("-inf"), float("inf"), 0, rank))
    if not brackets:
        return df.sparkSession.createDataFrame([], "column string, prob double, q_value double")
    hits = [F.when(F.col(c).between(lo, hi), F.struct(
        F.lit(c).alias("column"), F.lit(p).alias("prob"), F.lit(before).cast("bigint").alias("before"),
        F.lit(float(rank)).alias("rank"), F.col(c).alias("value"))) for c, p, lo, hi, before, rank in brackets]
    inside = plain.select(F.inline(F.filter(F.array(*hits), lambda x: x.isNotNull())))
    # a few values per bracket, read several times below
    values = cut_lineage(inside.groupBy("column", "prob", "before", "rank", "value").agg(F.count("*").alias("n")))
    running = prefix_sums(values, ["column", "prob"], "value", ["n"])
    upto = F.col("before") + F.col("cum_n")
    hits = running.filter((upto > F.floor("rank")) & (upto - F.col("n") <= F.ceil("rank")))
    return hits.groupBy("column", "prob").agg(
        (F.min("value") + (F.max("value") - F.min("value")) * F.max(F.col("rank") - F.floor("rank"))).alias("q_value"))
