"""Joins and groups whose keys may be hot.

``facts`` hold one row per key, among it the number of rows that have the key. A key with many rows is spread over salts on
both sides. The table that says which keys are hot is broadcast; it has at most ``MAX_HOT`` rows whatever the data, as a key
is hot only from ``total / MAX_HOT`` rows on.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wavelattice.session import fresh_cut

HOT_ROWS = 50_000         # rows of a key from which it is spread
MAX_HOT = 10_000          # bound of the broadcast table of hot keys
BROADCAST_FACTS = 50_000  # narrow facts up to this many rows are broadcast whole


def join_facts(rows: DataFrame, facts: DataFrame, key: str, count: str, spread: str, narrow: bool = True,
               how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``facts`` (except ``count``) for their ``key``; rows without facts go, or stay if ``how`` is left.

    ``spread`` is a column of ``rows`` whose values differ within a key. ``narrow`` facts are broadcast when they are few;
    others are left to the planner.
    """
    facts = fresh_cut(facts)
    size = facts.agg(F.count("*").alias("keys"), F.sum(count).alias("rows")).first()  # one row
    if narrow and size["keys"] <= BROADCAST_FACTS:
        return rows.join(F.broadcast(facts.drop(count)), key, how)
    per = max(HOT_ROWS, -(-(size["rows"] or 0) // MAX_HOT))
    digest = F.xxhash64(key)
    hot = facts.filter(F.col(count) > per).groupBy(digest.alias("_hot")).agg(
        F.ceil(F.max(count) / per).cast("int").alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1))
    hot = F.broadcast(hot)  # at most MAX_HOT rows of two numbers
    left = rows.join(hot, digest == F.col("_hot"), "left").withColumn("_salt", F.pmod(F.xxhash64(spread), salts).cast("int"))
    right = facts.drop(count).join(hot, digest == F.col("_hot"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    left, right = left.drop("_hot", "_salts"), right.drop("_hot", "_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def apply_with_facts(rows: DataFrame, facts: DataFrame, key: str, spread: str, func, result: str, size: int) -> DataFrame:
    """``func(rows, fact)`` as Arrow tables on groups of about ``size`` rows that share a key, with the one fact row of it.

    Rows without facts go. A key of any number of rows is many groups.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).join(facts.select(key), key, "left_semi")
    counts = fresh_cut(counts.withColumn("_groups", F.greatest(F.ceil(F.col("_n") / size), F.lit(1)).cast("int")))
    dealt = join_facts(rows, counts, key, "_n", spread).withColumn(
        "_group", F.pmod(F.xxhash64(spread, F.lit(17)), F.col("_groups")).cast("int")).drop("_groups")
    copies = facts.join(counts.select(key, "_groups"), key).withColumn(
        "_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups")
    copies = copies.select(*[F.col(c).alias(c) for c in copies.columns])  # both sides may stem from one table
    empty = result_schema(result).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return func(left, right) if left.num_rows and right.num_rows else empty

    return dealt.groupBy(key, "_group").cogroup(copies.groupBy(key, "_group")).applyInArrow(run, result)


def result_schema(result: str) -> pa.Schema:
    """Arrow schema of a ``name type, ...`` text of numbers."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split(" ") for c in result.split(", "))])
