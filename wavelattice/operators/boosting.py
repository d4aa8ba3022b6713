"""Boosted trees of many settings and folds that grow side by side.

A boosted tree needs those before it, so a fit is a chain of short jobs, and a search by separate fits is that chain times
settings times folds. Here one job grows a level of the current tree of every model. Rows stay dealt over the tasks: a cell holds
the binned rows of one part of the table for one model, tasks return histograms, which are summed and cut by key, and only the
chosen cuts and leaf values reach the driver. A table of one part (up to some 200,000 rows, which callers bring together) has nothing to sum between tasks, so
there a task grows the trees of one model and the models are dealt.

The trees are those of Spark's ``GBTRegressor`` and ``GBTClassifier``: squared or logistic loss, bins at the same candidate
thresholds, variance gain, first tree of weight one. Row samples are drawn by seed, round and part.
"""

from __future__ import annotations

import copy
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from wavelattice.session import files_at, scratch_path

#: Bins of a feature, and rows that candidate thresholds are taken from in a larger table (both as in Spark's trees).
BINS, SAMPLED = 32, 10_000
#: Rounds after which margins are taken from all trees again, so that their lineage stays short.
RENEW = 40


@dataclass(frozen=True)
class Setting:
    """One model to grow, on all rows but those of fold ``without``."""

    rounds: int
    depth: int
    step: float
    share: float
    without: int | None


# A tree is the arrays feature, cut, left and value of its nodes by level: plain, as it travels with every job. An inner node's
# children are left and left + 1, a leaf's feature is -1.
ROOT = (np.array([-1], np.int32), np.array([0], np.int32), np.array([0], np.int32), np.array([0.0]))


def place(tree: tuple, codes: np.ndarray, levels: int) -> np.ndarray:
    """The node of every row after ``levels`` steps down ``tree``."""
    feature, cut, left, _ = tree
    at, rows = np.zeros(len(codes), np.int32), np.arange(len(codes))
    for _ in range(levels):
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            break
        at = np.where(inner, left[at] + (codes[rows, np.maximum(f, 0)] > cut[at]), at)
    return at


def deeper(tree: tuple, first: int, found: tuple) -> tuple:
    """``tree`` with its nodes from ``first`` on cut as ``found`` (see :func:`_best`)."""
    feature, cut, left, value = tree
    values, features, cuts, below = found
    inner = features >= 0
    children = len(value) + 2 * np.cumsum(inner) - 2
    more = below[inner].ravel()
    none = np.zeros(len(more), np.int32)
    return (np.concatenate([feature[:first], features, none - 1]).astype(np.int32), np.concatenate([cut[:first], cuts, none]).astype(np.int32),
            np.concatenate([left[:first], np.where(inner, children, 0), none]).astype(np.int32), np.concatenate([value[:first], values, more]))


def binned(x: np.ndarray, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers of raw features; a value on a threshold is left of it."""
    out = np.empty(x.shape, np.uint8)
    for i, t in enumerate(thresholds):
        out[:, i] = np.searchsorted(t, x[:, i], side="left")
    return out


def thresholds_of(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """At most ``BINS - 1`` candidate thresholds of a feature from its distinct values in order."""
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) < BINS:
        return middle
    stride = weights.sum() / BINS
    out, target, total = [], stride, weights[0]
    for i in range(1, len(values)):
        before, total = total, total + weights[i]
        if abs(before - target) < abs(total - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out[:BINS - 1])


def _thresholds(rows: DataFrame, n: int, folds: Sequence[int | None], seed: int) -> dict[int | None, list[np.ndarray]]:
    """Candidate thresholds of every feature for the rows without each fold; a task holds the distinct values of one feature."""
    known = [f for f in folds if f is not None]
    if n > SAMPLED:
        rows = rows.sample(False, min(1.0, 1.5 * SAMPLED / n), seed)
    parts = [F.sum(F.when(F.col("fold").eqNullSafe(F.lit(f)), F.lit(0.0)).otherwise(F.col("weight"))).alias(f"w{i}") for i, f in enumerate(known)]
    counts = rows.select("fold", "weight", F.posexplode("x").alias("i", "v")).withColumn("v", F.col("v") + F.lit(0.0)).groupBy("i", "v").agg(
        F.sum("weight").alias("w"), *parts)

    def cut(table: pa.Table) -> pa.Table:
        v = table["v"].to_numpy()
        order = np.argsort(v)
        out = []
        for name in ("w", *[f"w{i}" for i in range(len(known))]):
            w = table[name].to_numpy()[order]
            out.append(thresholds_of(v[order][w > 0], w[w > 0]))
        return pa.table({"i": pa.array([table["i"][0].as_py()] * len(out), pa.int32()), "of": pa.array(range(-1, len(out) - 1), pa.int32()),
                         "t": pa.array([o.tolist() for o in out], pa.list_(pa.float64()))})

    found: dict = {f: {} for f in (None, *known)}
    for row in counts.groupBy("i").applyInArrow(cut, "i int, of int, t array<double>").collect():  # features x folds rows
        found[None if row["of"] < 0 else known[row["of"]]][row["i"]] = np.array(row["t"])
    return {f: [by[i] for i in sorted(by)] for f, by in found.items()}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a part as one block of bytes: features, then label, weight and fold."""
    tables = [b for b in batches if b.num_rows]
    if tables:
        table = pa.Table.from_batches(tables)
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        rest = [table[c].to_numpy().astype(float)[:, None] for c in ("label", "weight", "fold")]
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "width": pa.array([x.shape[1] + 3], pa.int32()),
                                          "block": pa.array([np.hstack([x, *rest]).tobytes()], pa.large_binary())})


def _cells(settings: Sequence[Setting], thresholds: dict):
    def cut(row) -> Iterator[tuple]:
        rows = np.frombuffer(row["block"]).reshape(-1, row["width"])
        codes = {f: binned(rows[rows[:, -1] != f] if f is not None else rows, t)[:, :len(t)] for f, t in thresholds.items()}
        for m, s in enumerate(settings):
            kept = rows[rows[:, -1] != s.without] if s.without is not None else rows
            yield (m, row["part"]), (codes[s.without], kept[:, -3].copy(), kept[:, -2].copy(), np.zeros(len(kept)))
    return cut


def _target(y: np.ndarray, margin: np.ndarray, r: int, logistic: bool) -> np.ndarray:
    """What the tree of round ``r`` learns: the label, then the negative gradient of the loss."""
    sign = 2.0 * y - 1.0 if logistic else y
    if r == 0:
        return sign
    return 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin)) if logistic else 2.0 * (y - margin)


def _summed(codes: np.ndarray, slot: np.ndarray, w: np.ndarray, t: np.ndarray, nodes: int) -> np.ndarray:
    """``w`` and ``t`` summed by node, feature and bin; ``codes`` by feature, then row."""
    out, base = np.empty((2, nodes, len(codes), BINS)), slot.astype(np.int64) * BINS
    for f, code in enumerate(codes):
        at = base + code
        out[0, :, f], out[1, :, f] = (np.bincount(at, v, nodes * BINS).reshape(nodes, BINS) for v in (w, t))
    return out


def _histograms(shares: list[float], growing: dict[int, tuple], r: int, level: int, logistic: bool, seed: int):
    """Weights and weighted targets by node, feature and bin of every cell whose model is in ``growing``: ``{model: (tree, first)}``."""
    def sums(cells) -> Iterator[tuple]:
        for (m, part), (codes, y, weight, margin) in cells:
            if m not in growing:
                continue
            tree, first = growing[m]
            if shares[m] < 1.0:
                weight = weight * (np.random.default_rng((seed, r, part)).random(len(y)) < shares[m])
            slot = place(tree, codes, level) - first
            kept = np.flatnonzero((slot >= 0) & (weight > 0))
            w = weight[kept]
            t = w * _target(y, margin, r, logistic)[kept]
            yield m, _summed(np.ascontiguousarray(codes[kept].T), slot[kept], w, t, len(tree[3]) - first)
    return sums


def _best(sums: np.ndarray) -> tuple:
    """``value, feature, cut, (left value, right value)`` per node; feature -1 where no cut lowers the variance."""
    (weight, total), nodes = sums, np.arange(sums.shape[1])
    w, t = weight[:, 0].sum(axis=1), total[:, 0].sum(axis=1)
    lw, lt = weight.cumsum(axis=2)[:, :, :-1], total.cumsum(axis=2)[:, :, :-1]
    rw, rt = w[:, None, None] - lw, t[:, None, None] - lt
    least = 1e-9 * np.maximum(w, 1e-300)[:, None, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = t * t / w
        gain = np.where((lw > least) & (rw > least), lt * lt / lw + rt * rt / rw - whole[:, None, None], -np.inf).reshape(len(w), -1)
        at = gain.argmax(axis=1)
        inner = gain[nodes, at] > 1e-12 * np.abs(whole)
        f, c = np.divmod(at, BINS - 1)
        below = np.stack([lt[nodes, f, c] / lw[nodes, f, c], rt[nodes, f, c] / rw[nodes, f, c]], axis=1)
        value = np.where(w > 0, t / w, 0.0)
    return value, np.where(inner, f, -1).astype(np.int32), c.astype(np.int32), below


def _alone(settings: list[tuple], logistic: bool, seed: int):
    """All trees of the models whose rows are one cell; ``settings`` as (rounds, depth, step, share)."""
    def fit(cells) -> Iterator[tuple]:
        for (m, part), (codes, y, weight, margin) in cells:
            rounds, depth, step, share = settings[m]
            trees, all_rows = [], np.arange(len(y))
            by_feature = np.ascontiguousarray(codes.T)
            for r in range(rounds):
                tree, first, at = ROOT, 0, np.zeros(len(y), np.int32)
                w = weight * (np.random.default_rng((seed, r, part)).random(len(y)) < share) if share < 1.0 else weight
                t = w * _target(y, margin, r, logistic)
                for level in range(depth):
                    if first == len(tree[3]):
                        break
                    if level:  # rows whose node was cut go on to its children
                        f = tree[0][at]
                        at = np.where(f >= 0, tree[2][at] + (codes[all_rows, np.maximum(f, 0)] > tree[1][at]), at)
                    kept = np.flatnonzero((at >= first) & (w > 0))
                    some = (by_feature, at - first, w, t) if len(kept) == len(y) else (by_feature[:, kept], at[kept] - first, w[kept], t[kept])
                    tree, first = deeper(tree, first, _best(_summed(*some, len(tree[3]) - first))), len(tree[3])
                margin = margin + (step if r else 1.0) * tree[3][place(tree, codes, depth)]
                trees.append(tree)
            yield m, [len(t[3]) for t in trees], pickle.dumps(trees)
    return fit


def _advanced(ways: list[tuple[int, float]], rounds, start: int, afresh: bool):
    """Margins moved on by the trees of ``rounds.value`` (by round, from round ``start``, then by model); ``ways``: depth and step."""
    def move(cells) -> Iterator[tuple]:
        for (m, part), (codes, y, weight, margin) in cells:
            depth, step = ways[m]
            margin = np.zeros(len(y)) if afresh else margin
            for r, trees in enumerate(rounds.value, start):
                if m in trees:
                    margin = margin + (step if r else 1.0) * trees[m][3][place(trees[m], codes, depth)]
            yield (m, part), (codes, y, weight, margin)
    return move


@dataclass(frozen=True)
class Written:
    """Trees of model ``model`` in a written table, of which tasks read their own; the driver knows their node counts only."""

    path: str
    model: int
    nodes: tuple[int, ...]

    def __len__(self) -> int:
        return len(self.nodes)

    def first(self, rounds: int) -> "Written":
        return replace(self, nodes=self.nodes[:rounds])

    def __iter__(self) -> Iterator[tuple]:
        where, inner = files_at(self.path)
        found = ds.dataset(inner, filesystem=where, format="parquet").to_table(columns=["trees"], filter=ds.field("model") == self.model)
        return iter(pickle.loads(found["trees"][0].as_py())[:len(self)])


@dataclass
class BoostedTrees:
    """A boosted model: adds ``prediction``, and ``probability`` for a logistic one, to rows with ``features``."""

    thresholds: list[np.ndarray]
    trees: list[tuple] | Written
    step: float
    logistic: bool
    prediction: str = "prediction"

    @property
    def numFeatures(self) -> int:
        return len(self.thresholds)

    @property
    def totalNumNodes(self) -> int:
        return sum(self.trees.nodes if isinstance(self.trees, Written) else (len(t[3]) for t in self.trees))

    def getNumTrees(self) -> int:
        return len(self.trees)

    def first(self, rounds: int) -> "BoostedTrees":
        """The model after ``rounds`` rounds."""
        out = copy.copy(self)
        out.trees = self.trees.first(rounds) if isinstance(self.trees, Written) else self.trees[:rounds]
        return out

    def setPredictionCol(self, name: str) -> "BoostedTrees":
        self.prediction = name
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        thresholds, trees, step = self.thresholds, self.trees, self.step

        @F.arrow_udf("double")
        def margin(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = list(trees)
            for x in batches:
                codes = binned(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(thresholds)), thresholds)
                out = np.zeros(len(x))
                for r, tree in enumerate(own):
                    out += (step if r else 1.0) * tree[3][place(tree, codes, len(tree[3]))]
                yield pa.array(out)

        score = margin(vector_to_array("features"))
        if not self.logistic:
            return df.withColumn(self.prediction, score)
        p = F.col("_margin")
        p = 1.0 / (1.0 + F.exp(-2.0 * p))
        return df.withColumn("_margin", score).withColumn("probability", array_to_vector(F.array(1.0 - p, p))).withColumn(
            self.prediction, (F.col("_margin") > 0).cast("double")).drop("_margin")


def grow(ready: DataFrame, settings: Sequence[Setting], logistic: bool, seed: int) -> list[BoostedTrees]:
    """The models of all ``settings`` on ``features, label, fold`` and optionally ``weight`` of ``ready``, a level of all of them a job."""
    sc = ready.sparkSession.sparkContext
    weight = F.col("weight").cast("double") if "weight" in ready.columns else F.lit(1.0)
    rows = ready.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"), weight.alias("weight"), "fold")
    sound = F.col("label").isin(0.0, 1.0) if logistic else F.col("label").isNotNull() & ~F.isnan("label")
    counts = {r["fold"]: r for r in rows.groupBy("fold").agg(F.count("*").alias("n"), F.count_if(~F.coalesce(sound, F.lit(False))).alias("bad")).collect()}
    n = sum(r["n"] for r in counts.values())
    if any(r["bad"] for r in counts.values()) or any(n == (counts[s.without]["n"] if s.without in counts else 0) for s in settings):
        raise ValueError(f"boosting needs rows, and labels that are {'0 or 1' if logistic else 'numbers'}")
    thresholds = _thresholds(rows, n, sorted({s.without for s in settings if s.without is not None}), seed)
    blocks = rows.mapInArrow(_blocks, "part int, width int, block binary").rdd
    parts = rows.rdd.getNumPartitions()
    plain = [(s.rounds, s.depth, s.step, s.share) for s in settings]
    cells = blocks.flatMap(_cells(settings, thresholds))
    if parts == 1:
        spark, path = ready.sparkSession, scratch_path(ready.sparkSession, "boosted")
        made = cells.partitionBy(len(settings), lambda key: key[0]).mapPartitions(_alone(plain, logistic, seed))
        spark.createDataFrame(made, "model int, nodes array<int>, trees binary").write.parquet(path)
        counts = spark.read.parquet(path).select("model", "nodes").collect()  # a row per model
        found = {r["model"]: Written(path, r["model"], tuple(r["nodes"])) for r in counts}
    else:
        found = _dealt_growth(cells, plain, parts, logistic, seed)
    return [BoostedTrees(thresholds[s.without], found[m], s.step, logistic) for m, s in enumerate(settings)]


def _dealt_growth(cells, settings: list[tuple], parts: int, logistic: bool, seed: int) -> dict[int, list[tuple]]:
    """All trees of all models, whose cells are dealt over the tasks: a job per level."""
    sc = cells.context
    shares, ways = [s[3] for s in settings], [s[1:3] for s in settings]
    many, k = min(len(settings) * parts, sc.defaultParallelism), len(settings)
    cells = cells.partitionBy(many, lambda key: key[1] * k + key[0]).persist(StorageLevel.MEMORY_AND_DISK)
    done: list[dict[int, tuple]] = []
    now, sent = cells, []
    for r in range(max(s[0] for s in settings)):
        growing = {m: (ROOT, 0) for m, s in enumerate(settings) if s[0] > r}
        trees, before = {m: tree for m, (tree, _) in growing.items()}, now
        if r:
            afresh = r % RENEW == 0
            rounds = sc.broadcast(done if afresh else done[-1:])
            now = (cells if afresh else before).mapPartitions(_advanced(ways, rounds, 0 if afresh else r - 1, afresh), True).persist(
                StorageLevel.MEMORY_AND_DISK)
            stale, sent = (sent, [rounds]) if afresh else ([], [*sent, rounds])
        for level in range(max(settings[m][1] for m in growing)):
            growing = {m: (tree, first) for m, (tree, first) in growing.items() if settings[m][1] > level and first < len(tree[3])}
            if not growing:
                break
            sums = now.mapPartitions(_histograms(shares, growing, r, level, logistic, seed))
            for m, found in sums.reduceByKey(np.add, min(k, many)).mapValues(_best).collect():  # one row per model
                tree, first = growing[m]
                trees[m] = deeper(tree, first, found)
                growing[m] = (trees[m], len(tree[3]))
        done.append(trees)
        if before is not now and before is not cells:
            before.unpersist()
        if r and afresh:
            for old in stale:
                old.unpersist()
    if now is not cells:
        now.unpersist()
    cells.unpersist()
    return {m: [done[r][m] for r in range(s[0])] for m, s in enumerate(settings)}
