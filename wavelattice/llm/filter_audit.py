"""Filter interaction audit with decision diagrams.

Every document gets a mask of the filters it fails. Masks are counted by part (source) in Spark; a part has at most
``2 ** filters`` of them, however many documents it holds. For each part the masks become a decision diagram: a level per
filter, a node per distinct remainder, weighted by the documents that fall into it (all, good, toxic). The orders of the
filters are walked so that each differs from the one before by two neighbours, and the diagram follows by swapping those
two levels: only their nodes are rebuilt. The path on which every filter passes then tells what each step keeps and removes.

Null texts are empty (they fail the length filter only, and as texts equal to each other the copy filter). A null source is
the empty string. A document is good or toxic if any of its label rows says so; null labels say nothing. Rows that repeat an
id are documents of their own; a null id is neither smaller nor larger than another. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from wavelattice.llm.common import WORD, table

FILTERS = "ABCDE"
_COPY = FILTERS.index("E")


def text_failures(text: Column) -> Column:
    """Bit mask of the failures A to D that depend on the text alone."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    words = F.size(found)
    distinct = F.size(F.array_distinct(found))
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = (words < 50, distinct * 100 < words * 65, upper * 100 > F.length(text) * 5, text.rlike(r"[#$%&*|]"))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def weighted_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by failure mask. Only hashes of texts are shuffled, never texts.

    Copies share everything but id, part and labels, so they are counted by those first; a text held by a third of all
    documents is then a few rows (one per part and label), and its smallest id is found among them.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("same"),
                       text_failures(text).alias("mask"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = rows.join(marks, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "part", "same", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    kinds = ["part", "mask", "good", "toxic"]
    once = rows.groupBy("doc_id", "same", *kinds).agg(F.count("*").alias("c"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "c")))
    unnamed = F.sum(F.when(F.col("doc_id").isNull(), F.col("c")).otherwise(0))
    groups = once.groupBy("same", *kinds).agg(F.sum("c").alias("n"), least.alias("least"), unnamed.alias("unnamed"))
    first = F.min("least.doc_id").over(Window.partitionBy("same"))
    kept = F.col("unnamed") + F.when(F.col("least.doc_id") == first, F.col("least.c")).otherwise(0)
    split = groups.withColumn("_kept", kept).select(*kinds, F.explode(F.array(
        F.struct(F.lit(0).alias("e"), F.col("_kept").alias("n")),
        F.struct(F.lit(1 << _COPY).alias("e"), (F.col("n") - F.col("_kept")).alias("n")))).alias("x"))
    split = split.select("part", (F.col("mask") + F.col("x.e")).alias("mask"), F.col("x.n").alias("n"), "good", "toxic").where("n > 0")
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                             F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def adjacent_orders(k: int) -> Iterator[tuple[tuple[int, ...], int | None]]:
    """All orders of ``0..k-1``, each with the level whose swap with the next one led to it (None for the first)."""
    order, heading = list(range(k)), [-1] * k
    yield tuple(order), None
    while True:
        # the largest value that looks at a smaller neighbour moves (plain changes)
        best = -1
        for i, v in enumerate(order):
            j = i + heading[v]
            if 0 <= j < k and order[j] < v and (best < 0 or v > order[best]):
                best = i
        if best < 0:
            return
        v = order[best]
        j = best + heading[v]
        order[best], order[j] = order[j], order[best]
        for w in range(v + 1, k):
            heading[w] = -heading[w]
        yield tuple(order), min(best, j)


class Diagram:
    """Ordered decision diagram over failure masks: ``order[i]`` is decided at level ``i``.

    A node is ``(weights, pass child, fail child)``, the children on the next level (None: no document). Nodes of a level
    are shared when equal, so documents of equal remainders meet. Leaves are weight tuples.
    """

    def __init__(self, masks: dict[int, tuple], k: int):
        self.k, self.order = k, list(range(k))
        self.levels: list[dict] = [{} for _ in range(k)]
        self.root = self._build(masks, 0)

    def _build(self, masks: dict[int, tuple], level: int):
        if not masks:
            return None
        if level == self.k:
            return next(iter(masks.values()))
        bit = 1 << self.order[level]
        low = self._build({m: w for m, w in masks.items() if not m & bit}, level + 1)
        high = self._build({m: w for m, w in masks.items() if m & bit}, level + 1)
        return self._node(level, low, high)

    def weight(self, node, level: int) -> tuple | None:
        return node if node is None or level == self.k else node[0]

    def _node(self, level: int, low, high):
        if low is None and high is None:
            return None
        a, b = self.weight(low, level + 1), self.weight(high, level + 1)
        total = a if b is None else b if a is None else tuple(x + y for x, y in zip(a, b))
        key = (total, id(low) if level + 1 < self.k else low, id(high) if level + 1 < self.k else high)
        return self.levels[level].setdefault(key, (total, low, high))

    def swap(self, i: int) -> None:
        """Exchange levels ``i`` and ``i + 1``; levels below stay as they are, nodes above only follow their children."""
        old, self.levels[i], self.levels[i + 1] = self.levels[i], {}, {}
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]
        moved = {}
        for node in old.values():
            (_, pp, pf), (_, fp, ff) = (child or (None, None, None) for child in node[1:])
            moved[id(node)] = self._node(i, self._node(i + 1, pp, fp), self._node(i + 1, pf, ff))
        for above in range(i - 1, -1, -1):
            held, self.levels[above], after = self.levels[above], {}, {}
            for node in held.values():
                after[id(node)] = self._node(above, *(child and moved[id(child)] for child in node[1:]))
            moved = after
        self.root = self.root and moved[id(self.root)]

    def steps(self) -> Iterator[tuple[tuple, tuple]]:
        """Weights kept and removed by each level along the path on which all pass."""
        node, zero = self.root, (0, 0, 0)
        for level in range(self.k):
            low, high = node[1:] if node else (None, None)
            yield self.weight(low, level + 1) or zero, self.weight(high, level + 1) or zero
            node = low


_ROWS = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
         "good_lost bigint, toxic_lost bigint, shapley bigint")


def order_rows(part: str, masks: dict[int, tuple], names: Sequence[str]) -> list[tuple]:
    """The steps of all orders of the filters over the weighted masks of one part."""
    k = len(names)
    failing = [sum(w[0] for m, w in masks.items() if m >> f & 1) for f in range(k)]
    alone = [masks.get(1 << f, (0,))[0] for f in range(k)]
    share, out, diagram = [0] * k, [], Diagram(masks, k)
    for order, level in adjacent_orders(k):
        if level is not None:
            diagram.swap(level)
        name = "".join(names[f] for f in order)
        for step, (f, (kept, removed)) in enumerate(zip(order, diagram.steps()), 1):
            share[f] += removed[0]
            out.append((f, (part, name, step, kept[0], removed[0], failing[f] - removed[0], alone[f], removed[1], removed[2])))
    return [(*row, share[f]) for f, row in out]


def audit(masks: DataFrame, names: Sequence[str] = FILTERS) -> DataFrame:
    """All steps of all orders per part from ``part, mask, n, good, toxic`` (one row per part and mask)."""
    columns = [c.split()[0] for c in _ROWS.split(", ")]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(rows["mask"], rows["n"], rows["good"], rows["toxic"])}
        return pd.DataFrame(order_rows(key[0], found, names), columns=columns)

    return masks.groupBy("part").applyInPandas(run, _ROWS)


def query(spark, sf: str) -> DataFrame:
    return audit(weighted_masks(table(spark, sf, "documents"), table(spark, sf, "labels")))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INTEGER) AS g, max((toxic IS NOT DISTINCT FROM 1)::INTEGER) AS x
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(g, 0) AS g, coalesce(x, 0) AS x,
    (len(w) < 50)::INTEGER + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INTEGER
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INTEGER
    + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INTEGER AS m
    FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, m, count(*) AS n, sum(g) AS g, sum(x) AS x FROM f GROUP BY part, m),
b AS (SELECT i, substr('ABCDE', i + 1, 1) AS ch FROM range(5) r(i)),
o AS (SELECT '' AS ord, 0 AS step, '' AS ch, 0::BIGINT AS before, 0::BIGINT AS bit
      UNION ALL SELECT o.ord || b.ch, o.step + 1, b.ch, o.before + o.bit, 1::BIGINT << b.i FROM o, b WHERE NOT contains(o.ord, b.ch)),
s AS (SELECT whole.ord AS filter_order, o.step, o.ch, o.before, o.bit FROM o JOIN o whole ON length(whole.ord) = 5
      AND o.step > 0 AND starts_with(whole.ord, o.ord)),
r AS (SELECT part, filter_order, step::INTEGER AS step, ch,
    coalesce(sum(n) FILTER (m & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (m & before = 0 AND m & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (m & before <> 0 AND m & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (m = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(g) FILTER (m & before = 0 AND m & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(x) FILTER (m & before = 0 AND m & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, ch)
SELECT * EXCLUDE (ch), (sum(removed) OVER (PARTITION BY part, ch))::BIGINT AS shapley FROM r
"""
