"""Benchmark decontamination with spaced seeds.

A seed is a mask over consecutive words: the words at its ones are hashed, those at its zeros may be anything. The seeds of
all benchmark items are looked up at every position of every document, so a passage is found although words in it were
replaced. Each hit fixes an alignment of document and item; the words around it are compared one by one, and a passage
counts if a stretch with at least 80 % equal words is long enough, or most of the item is there.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wavelattice.llm.common import free_name, fresh_path, table, text_pieces
from wavelattice.llm.tokens import FOLD_ALNUM, PLACES, U64, combined, words
from wavelattice.operators.skew import join_facts

#: The second to fourth still match where every fifth, fourth or third word was replaced. Together they hit every choice of
#: unequal words in passages of 13 to 23 words with at least 80 % equal ones.
MASKS = ("111111", "1111011", "1110111", "11011011", "1100101101", "11110101")
SHIFTS = tuple(tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS)
MIN_WORDS = 13
MIN_SHARE = Fraction(4, 5)
MIN_ITEM_SHARE = 0.6
#: Text of the benchmark that is broadcast at a time; more is searched in further jobs.
SLICE_BYTES = 4 << 20
_BITMAP_BITS = 22
_HITS = "array<struct<item_id:bigint,matched:int,aligned:int,start:int>>"
_HIT_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("matched", pa.int32()), ("aligned", pa.int32()), ("start", pa.int32())]))


class Seeds:
    """Words and seeds of some benchmark items. Items of fewer than six words have no seed."""

    def __init__(self, ids: list[int], texts: list[str]):
        raw = [t.lower().encode() for t in texts]
        data = FOLD_ALNUM[np.frombuffer(b"".join(raw), np.uint8)]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
        _, _, owner, h = words(data, offsets)
        cut = np.searchsorted(owner, np.arange(len(ids) + 1))
        self.ids, self.words = ids, [h[i:j] for i, j in zip(cut, cut[1:])]
        keys, items, places = [], [], []
        for m, shifts in enumerate(SHIFTS):
            x = combined(h, shifts) + PLACES[100 + m]
            at = np.arange(len(x))
            whole = owner[:len(x)] == owner[shifts[-1]:] if len(x) else np.zeros(0, bool)
            keys.append(x[whole]), items.append(owner[:len(x)][whole]), places.append((at - cut[owner[:len(x)]])[whole])
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.place = key[order], np.concatenate(items)[order], np.concatenate(places)[order]
        self.bitmap = np.zeros(1 << _BITMAP_BITS, bool)
        self.bitmap[self.key >> U64(64 - _BITMAP_BITS)] = True

    def overlaps(self, data: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
        """Per text its best overlap with every item that it contains a passage of."""
        out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        _, _, owner, h = words(FOLD_ALNUM[data], offsets)
        found = []
        for m, shifts in enumerate(SHIFTS):
            x = combined(h, shifts) + PLACES[100 + m]
            at = np.flatnonzero(self.bitmap[x >> U64(64 - _BITMAP_BITS)])
            lo, hi = np.searchsorted(self.key, x[at], "left"), np.searchsorted(self.key, x[at], "right")
            at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            inside = owner[at] == owner[at + shifts[-1]] if len(at) else np.zeros(0, bool)
            at, lo, n = at[inside], lo[inside], n[inside]
            entry = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else lo
            if len(entry):
                found.append(np.stack([np.repeat(owner[at], n), self.item[entry], np.repeat(at, n) - self.place[entry]], axis=1))
        if not found:
            return out
        first = np.searchsorted(owner, np.arange(len(offsets)))
        best: dict[tuple[int, int], tuple] = {}
        for doc, item, begin in np.unique(np.concatenate(found), axis=0).tolist():
            hit = _aligned(h[first[doc]:first[doc + 1]], self.words[item], begin - int(first[doc]))
            if hit is not None:
                best[doc, item] = max(best.get((doc, item), hit), hit)
        for (doc, item), (matched, aligned, start) in sorted(best.items()):
            out[doc].append({"item_id": self.ids[item], "matched": matched, "aligned": aligned, "start": -start})
        return out


def _aligned(doc: np.ndarray, item: np.ndarray, begin: int):
    """Equal words, length and (negative) start of the passage with the item's first word at ``begin``, if it counts."""
    lo, hi = max(0, -begin), min(len(item), len(doc) - begin)
    same = doc[begin + lo:begin + hi] == item[lo:hi]
    # a stretch has the share if its gain is not negative; the longest one, in whole numbers
    equal, other = MIN_SHARE.denominator - MIN_SHARE.numerator, MIN_SHARE.numerator
    gain = np.concatenate([[0], np.cumsum(np.where(same, equal, -other))])
    ahead = np.maximum.accumulate(gain[::-1])[::-1]
    last = np.searchsorted(-ahead, -gain, side="right") - 1
    start = int(np.argmax(last - np.arange(len(last))))
    end = int(last[start])
    long_enough = end - start >= MIN_WORDS
    inside = np.flatnonzero(same[start:end])
    if len(inside):  # reported without unequal words at its ends
        start, end = start + int(inside[0]), start + int(inside[-1]) + 1
    length, matched, total = end - start, int(same[start:end].sum()), int(same.sum())
    if total >= max(MIN_ITEM_SHARE * len(item), len(SHIFTS[0])):  # most of the item is here
        if total > matched:
            length, matched, start = hi - lo, total, 0
    elif not long_enough:
        return None
    return matched, length, -(begin + lo + start)


def with_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                  slice_bytes: int = SLICE_BYTES, into: str = "overlaps") -> DataFrame:
    """``docs`` with a column ``overlaps``: one entry per benchmark item of which the text contains a passage.

    Words are runs of letters and digits, in lower case. An entry has the item, the equal words, the length of the passage and its
    first word in the document; the passage is the longest stretch with the share, less unequal words at its ends. Null texts have none; null ids and null, empty or short items (under six words) are not
    searched; items that repeat an id are searched each. All other columns stay, whatever their names are, but for
    ``into``, which is replaced. An empty table gives an empty result. The benchmark is broadcast in slices of bounded size. A
    single slice is one pass without any shuffle. Of several each has a job of its own, which writes the overlaps of the
    texts that have any to the shared folder, and the broadcast is freed before the next one is made.
    """
    items = benchmark.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item).cast("bigint").alias("_id"), F.col(item_text).alias("_t"))
    n_bytes = items.agg(F.coalesce(F.sum(F.octet_length("_t")), F.lit(0))).first()[0]
    slices = max(1, math.ceil(n_bytes / slice_bytes))
    at = F.pmod(F.xxhash64("_id", "_t"), F.lit(slices))
    spark = docs.sparkSession
    docs = docs.drop(into)
    whole, same, found = (free_name(docs, x) for x in ("_decontam_text", "_decontam_same", "_decontam_hits"))
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))

    def seeds(i: int):
        part = sorted((r["_id"], r["_t"]) for r in items.where(at == i).collect())  # about slice_bytes of text
        return spark.sparkContext.broadcast(vars(Seeds([x for x, _ in part], [t for _, t in part])))

    kept = [F.col(f"`{c}`") for c in docs.columns]
    if slices == 1:
        return _searched(docs.withColumn(whole, lowered), seeds(0), whole, found).select(*kept, F.col(found).alias(into))
    texts = docs.select(F.unhex(F.sha2(lowered.cast("binary"), 256)).alias("same"), lowered.alias("whole"))
    hits = None
    for i in range(slices):
        shared, path = seeds(i), fresh_path(spark, f"overlaps-{i}")
        _searched(texts, shared, "whole", "hits").where(F.size("hits") > 0).select("same", "hits").write.parquet(path)
        shared.destroy()
        part = spark.read.parquet(path).withColumn("slice", F.lit(i))
        hits = part if hits is None else hits.unionByName(part)
    # copies of a text have equal overlaps: one of them stands for all, and their number tells how far to spread the join
    each = hits.groupBy("same", "slice").agg(F.first("hits").alias("hits"), F.count("*").alias("n"))
    facts = each.groupBy(F.col("same").alias(same)).agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("slice", "hits"))), lambda x: x["hits"])).alias(found), F.max("n").alias("_n"))
    at_row = free_name(docs, "_decontam_at")
    rows = docs.withColumn(same, F.unhex(F.sha2(lowered.cast("binary"), 256))).withColumn(at_row, F.monotonically_increasing_id())
    joined = join_facts(rows, facts, same, "_n", at_row, narrow=False, how="left")
    return joined.select(*kept, F.coalesce(found, F.array().cast(_HITS)).alias(into))


def _searched(docs: DataFrame, seeds, whole: str, into: str) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        lookup = Seeds.__new__(Seeds)
        vars(lookup).update(seeds.value)
        for part, data, offsets in text_pieces(batches, whole):
            hits = lookup.overlaps(data, offsets)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(hits, _HIT_TYPE)], names=[*part.schema.names, into])

    return docs.mapInArrow(run, f"{schema}, `{into}` {_HITS}")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and benchmark item of which it contains a passage; see :func:`with_overlaps`."""
    rows = with_overlaps(docs.select(F.col(key), F.col(text)), benchmark, text).select(key, F.explode("overlaps").alias("o"))
    return rows.select(key, "o.*")


def query(spark, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
