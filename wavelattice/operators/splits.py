"""Splits, folds, samples and scaling that do not depend on partitioning.

Randomness is the order of an MD5 digest of (seed, key). Positions in that order are needed only
as counts: the digest's first hex digits cut each class into even buckets, bucket counts are
prefix-summed, and rows are ordered only inside a bucket. No class is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wavelattice import schema as S
from wavelattice.functions.scalars import keyed_digest

BUCKET_HEX_DIGITS = 3  # 4096 buckets per class


def _bucketed(df: DataFrame, key: str, label: str | None, seed: int) -> DataFrame:
    digest = F.coalesce(keyed_digest(F.col(key), seed), F.lit(""))
    # rows without a label are a class of their own
    cls = F.coalesce(F.col(label).cast("string"), F.lit("\0null")) if label else F.lit("all")
    return df.withColumn("_d", digest).withColumn("_c", cls).withColumn(
        "_b", F.substring("_d", 1, BUCKET_HEX_DIGITS))


def _bucket_offsets(bucketed: DataFrame) -> DataFrame:
    """Per (class, bucket): rows before it in its class, its own size and the class size."""
    counts = bucketed.groupBy("_c", "_b").agg(F.count("*").alias("_n"))
    order = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_c", "_b", "_n", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"),
                         F.sum("_n").over(Window.partitionBy("_c")).alias("_class_n"))


def _test_quotas(offsets: DataFrame, fraction: float) -> DataFrame:
    """Test rows per class, one row per class."""
    sizes = offsets.groupBy("_c").agg(F.sum("_n").alias("_size"))
    everything = Window.partitionBy(F.lit(1))  # over one row per class
    n_test = F.ceil(F.sum("_size").over(everything) * F.lit(fraction))
    ideal = sizes.withColumn("_total_test", n_test).withColumn(
        "_ideal", F.col("_size") / F.sum("_size").over(everything) * F.col("_total_test"))
    rest = F.col("_ideal") - F.floor("_ideal")
    ranked = (ideal.withColumn("_place", F.row_number().over(everything.orderBy(F.desc(F.round(rest, 9)), "_c")))
              .withColumn("_left", F.col("_total_test") - F.sum(F.floor("_ideal")).over(everything)))
    return ranked.select("_c", (F.floor("_ideal") + (F.col("_place") <= F.col("_left")).cast("int")).alias("_q"))


def stratified_split(df: DataFrame, key: str, label: str, test_fraction: float = S.TEST_FRACTION,
                     seed: int = S.SEED, name: str = "split") -> DataFrame:
    """Add a ``train``/``test`` column with an exact quota per class.

    ``ceil(fraction * rows)`` rows are test rows, shared out by class size with the largest
    remainders rounded up; of every class they are the first in digest order. A bucket before the quota is wholly test, one behind it wholly train; only the one bucket of each
    class that holds the boundary is ordered, and only its threshold digest is joined back.
    Wide rows are never shuffled.
    """
    bucketed = _bucketed(df, key, label, seed)
    offsets = _bucket_offsets(bucketed.select("_c", "_b"))
    edge = offsets.join(F.broadcast(_test_quotas(offsets, test_fraction)), "_c").filter(
        (F.col("_before") < F.col("_q")) & (F.col("_before") + F.col("_n") >= F.col("_q")))
    # at most one row per class
    narrow = bucketed.select("_c", "_b", "_d")
    inside = narrow.join(F.broadcast(edge.select("_c", "_b", (F.col("_q") - F.col("_before")).alias("_take"))),
                         ["_c", "_b"])
    ranked = inside.withColumn("_r", F.row_number().over(Window.partitionBy("_c", "_b").orderBy("_d")))
    threshold = ranked.filter(F.col("_r") == F.col("_take")).select(
        F.col("_c").alias("_tc"), F.col("_d").alias("_last_test"))
    marked = bucketed.join(F.broadcast(threshold), F.col("_c") == F.col("_tc"), "left")
    is_test = F.coalesce(F.col("_d") <= F.col("_last_test"), F.lit(False))
    return marked.select(*df.columns, F.when(is_test, "test").otherwise("train").alias(name))


def stratified_folds(df: DataFrame, key: str, label: str | None, k: int = 5, seed: int = S.SEED,
                     name: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1; fold sizes differ by at most one key within every class.

    Only distinct (class, bucket, key) are ordered; the fold joins back on key and class, so wide rows move at most
    once. Rows that share key and class share the fold; null keys and null labels count as values.
    """
    bucketed = _bucketed(df.select(key, *([label] if label else [])).distinct(), key, label, seed)
    offsets = _bucket_offsets(bucketed)
    rank = F.row_number().over(Window.partitionBy("_c", "_b").orderBy("_d"))
    placed = bucketed.withColumn("_r", rank).join(offsets.select("_c", "_b", "_before"), ["_c", "_b"])
    fold = ((F.col("_before") + F.col("_r") - 1) % k).cast("int")
    match = F.col(key).eqNullSafe(F.col("_fk"))
    if label:
        match = match & F.col(label).eqNullSafe(F.col("_fl"))
    placed = placed.select(F.col(key).alias("_fk"), *([F.col(label).alias("_fl")] if label else []), fold.alias(name))
    return df.join(placed, match).drop("_fk", "_fl")


def contiguous_folds(df: DataFrame, order: str, k: int = 3, name: str = "fold") -> DataFrame:
    """Unshuffled folds: the rows in ``order`` cut into k near-equal runs.

    The first ``n % k`` folds have one row more. Positions come from distributed prefix sums. Rows of equal order (nulls
    first) share the fold of the first of them.
    """
    from wavelattice.operators.quantiles import prefix_sums
    ones = df.groupBy(F.col(order).alias("_fk")).agg(F.count("*").alias("one"))
    placed = prefix_sums(ones, [], "_fk", ["one"])
    total = df.agg(F.count("*").alias("_n"))
    pos = F.col("cum_one") - F.col("one")
    small = F.floor(F.col("_n") / k)
    extra = F.col("_n") % k
    fold = F.when(pos < extra * (small + 1), F.floor(pos / (small + 1))).otherwise(
        extra + F.floor(F.try_divide(pos - extra * (small + 1), small)))
    folds = placed.join(F.broadcast(total)).select("_fk", fold.cast("int").alias(name))  # one row
    return df.join(folds, F.col(order).eqNullSafe(F.col("_fk"))).drop("_fk")


def sampled_subset(df: DataFrame, key: str, n: int, seed: int = S.SEED) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) without replacement; the same rows on every run.

    A top-n by digest. Counts per digest prefix (65536 at most) tell first which prefixes the
    sample can reach, so that only about ``n`` rows plus one prefix, not ``n`` rows of every
    partition, meet in the final sort.
    """
    digests = df.withColumn("_d", keyed_digest(F.col(key), seed)).withColumn("_b", F.substring("_d", 1, 4))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over prefix counts
    reach = digests.groupBy("_b").agg(F.count("*").alias("_n")).select(
        "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    last = reach.filter(F.col("_before") < n).agg(F.max("_b").alias("_last"))  # one row
    near = digests.join(F.broadcast(last), F.col("_b") <= F.col("_last"))
    return near.orderBy("_d").limit(n).select(*df.columns)


def scaler_statistics(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column (0 becomes 1), as one aggregate row."""
    row = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def apply_scaling(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """Columns shifted and divided by previously fitted statistics."""
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


def standard_scale(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """Z-scores with mean and population deviation of the train rows only; stays lazy.

    The statistics are one row, joined back as such.
    """
    columns = list(columns)
    train = df.filter(F.col(split) == "train")
    stats = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"_m_{c}") for c in columns],
                      *[F.stddev_pop(F.col(c).cast("double")).alias(f"_s_{c}") for c in columns])
    joined = df.join(F.broadcast(stats))
    scaled = {c: (F.col(c).cast("double") - F.col(f"_m_{c}"))
              / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(F.lit(1.0)) for c in columns}
    return joined.withColumns(scaled).select(*df.columns)


def scale_and_split(df: DataFrame, key: str = "sample_id", label: str = "NLOS",
                    columns: Sequence[str] = tuple(S.SCALARS), test_fraction: float = S.TEST_FRACTION,
                    seed: int = S.SEED) -> DataFrame:
    """Stratified split first, then scaling fitted on its train part."""
    return standard_scale(stratified_split(df, key, label, test_fraction, seed), columns)


def split_check(df: DataFrame, key: str, label: str, split: str = "split") -> DataFrame:
    """Per class: train and test sizes and the number of keys present in both parts."""
    per_key = df.groupBy(key, F.col(label).alias("label")).agg(
        F.max((F.col(split) == "train").cast("int")).alias("tr"),
        F.max((F.col(split) == "test").cast("int")).alias("te"))
    return per_key.groupBy("label").agg(F.sum("tr").alias("n_train"), F.sum("te").alias("n_test"),
                                        F.sum(F.col("tr") * F.col("te")).alias("n_both"))
