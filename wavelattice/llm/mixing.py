"""Mixing sources to target weights with nested hash-threshold histograms.

Every source gets a budget of words. A source whose budget exceeds its size is taken whole as often as it fits; the rest
of the budget is filled with the documents whose hash lies below a threshold. The threshold is found without sorting:
words are summed by source and the top bits of the hash, the bucket in which the running sum crosses the budget is
known, and only that bucket is split by the next bits, until it holds a single hash value. The documents of that hash
are cut: each gives the same share of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wavelattice.llm.common import WORD, settled, table

BITS = 12
LEVELS = 5
MAX_REPEATS = 3
#: Sources up to which the table of one row per source is broadcast; beyond, it is joined by the planner's choice.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def doc_hash(key: Column, seed: str) -> Column:
    """60-bit hash of a document key (null: as the empty string)."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, BITS * LEVELS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights=(5, 2, 1), max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``_src, source_size, target`` from one row ``_src, source_size`` per source.

    Sources in code point order, null last, take the weights in turn. Everything is shared by weight; a target stops at
    ``max_repeats`` times its source and the excess is shared again. That is water filling: a source is capped exactly
    if its cap over its weight is at most the common level, so one ordered pass over the sources decides.
    The table has one row per source; it is the only thing that is ordered.
    """
    by_name = Window.orderBy(F.col("_src").isNull(), F.col("_src").cast("binary"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (turn + 1).cast("int")).cast("bigint")
    s = sizes.withColumn("_w", w).withColumn("_cap", F.col("source_size") * max_repeats)
    fullness = Window.orderBy((F.col("_cap") / F.col("_w")), F.col("_src").isNull(), F.col("_src").cast("binary"))
    everything = fullness.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = fullness.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_all", F.sum("source_size").over(everything)).withColumn("_allw", F.sum("_w").over(everything))
    s = s.withColumn("_left", F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
    s = s.withColumn("_leftw", F.col("_allw") - F.coalesce(F.sum("_w").over(before), F.lit(0)))
    s = s.withColumn("_capped", F.col("_cap") * F.col("_leftw") <= F.col("_w") * F.col("_left"))
    # the sources after the capped ones share what is left at one level
    level = F.min(F.when(~F.col("_capped"), F.struct(F.col("_cap") / F.col("_w"), "_left", "_leftw"))).over(everything)
    s = s.withColumn("_lv", level)
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(
        (F.col("_w") * F.col("_lv._left")).cast("double") / F.col("_lv._leftw").cast("double"))
    return s.select("_src", "source_size", target.alias("target"))


def _with_sources(df: DataFrame, per_source: DataFrame, n_sources: int) -> DataFrame:
    """Inner join on the source, nulls equal."""
    small = F.broadcast(per_source) if n_sources <= BROADCAST_SOURCES else per_source
    return df.join(small, df["_src"].eqNullSafe(small["_s"])).drop("_s")


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                weights=(5, 2, 1), max_repeats: int = MAX_REPEATS, seed: str = "mix") -> DataFrame:
    """One row per document: the key, ``size, source_size, target, taken`` and ``_src`` (its source).

    Null and empty texts have size 0 and are never taken; a source of size 0 has target 0. Rows that share a key share
    a hash and so their fate: if they meet the threshold, each gives the same share of its words. Repeated rows stay
    separate rows. An empty table gives an empty result. Other columns are not read.
    """
    rows = settled(docs.select(F.col(key).alias("_key"), F.col(source).alias("_src"), word_count(F.col(text)).alias("size"),
                               doc_hash(F.col(key), seed).alias("_h")))
    sizes = rows.groupBy("_src").agg(F.sum("size").alias("source_size"))
    targets = settled(source_targets(sizes, weights, max_repeats))
    n_sources = targets.count()
    budget = F.round("target").cast("bigint")
    full = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    state = targets.select(
        F.col("_src").alias("_s"), "source_size", "target", full.alias("_full"),
        (budget - full * F.col("source_size")).alias("_rest"),
        F.lit(0).cast("bigint").alias("_prefix"), F.lit(0).cast("bigint").alias("_below"))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        inside = _with_sources(rows, state.select("_s", "_prefix"), n_sources).where(
            F.shiftright("_h", shift + BITS) == F.col("_prefix"))
        hist = inside.groupBy("_src", F.shiftright("_h", shift).alias("_bucket")).agg(F.sum("size").alias("_sum"))
        run = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_before", F.coalesce(F.sum("_sum").over(run), F.lit(0)))
        # the bucket that reaches the rest of the budget; if none does, the last one
        found = hist.join(F.broadcast(state.select("_s", "_rest", F.col("_below").alias("_b0")))
                          if n_sources <= BROADCAST_SOURCES else state.select("_s", "_rest", F.col("_below").alias("_b0")),
                          F.col("_src").eqNullSafe(F.col("_s")))
        found = found.where(F.col("_b0") + F.col("_before") <= F.col("_rest")).groupBy("_s").agg(
            F.max(F.struct(F.col("_bucket"), (F.col("_b0") + F.col("_before")).alias("b"), F.col("_sum"))).alias("_f"))
        state = settled(state.alias("a").join(found.alias("b"), F.col("a._s").eqNullSafe(F.col("b._s"))).select(
            "a._s", "source_size", "target", "_full", "_rest", F.col("_f._bucket").alias("_prefix"),
            F.col("_f.b").alias("_below"), F.col("_f._sum").alias("_group")))
    out = _with_sources(rows, state, n_sources)
    share = F.least(F.greatest(F.col("_rest") - F.col("_below"), F.lit(0)), F.col("_group"))
    part = F.when(F.col("_h") < F.col("_prefix"), F.col("size")).when(
        (F.col("_h") == F.col("_prefix")) & (F.col("_group") > 0),
        F.floor((F.col("size") * share).cast("double") / F.col("_group").cast("double")).cast("bigint")).otherwise(F.lit(0))
    return out.select(F.col("_key").alias(key), "size", "source_size", "target",
                      (F.col("_full") * F.col("size") + part).cast("bigint").alias("taken"), "_src")


def query(spark, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source::BLOB) - 1) % 3
    WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS w, 3 * source_size AS cap FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER ())::BIGINT
      - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source::BLOB ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lft,
    (sum(w) OVER ())::BIGINT
      - coalesce(sum(w) OVER (ORDER BY cap / w, source IS NULL, source::BLOB ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lftw FROM s1),
s3 AS (SELECT *, cap::HUGEINT * lftw <= w::HUGEINT * lft AS capped FROM s2),
lv AS (SELECT lft, lftw FROM s3 WHERE NOT capped ORDER BY cap / w, source IS NULL, source::BLOB LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE
    ELSE (w * (SELECT lft FROM lv))::DOUBLE / (SELECT lftw FROM lv)::DOUBLE END AS target FROM s3),
b AS (SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS full_times FROM t),
r AS (SELECT *, round(target)::BIGINT - full_times * source_size AS rest FROM b),
g AS (SELECT source, h, sum(size)::BIGINT AS grp FROM d GROUP BY source, h),
c AS (SELECT source, h, grp, (sum(grp) OVER (PARTITION BY source ORDER BY h) - grp)::BIGINT AS below FROM g)
SELECT d.doc_id, d.size, r.source_size, r.target,
  (r.full_times * d.size + CASE WHEN c.below + c.grp <= r.rest THEN d.size WHEN c.below >= r.rest OR c.grp = 0 THEN 0
    ELSE floor((d.size * (r.rest - c.below))::DOUBLE / c.grp::DOUBLE)::BIGINT END)::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""
