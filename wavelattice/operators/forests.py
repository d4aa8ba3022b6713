"""Random forests whose trees grow whole within tasks and never meet on the driver.

The train rows are written once, a column per feature. A task reads them as ranks of the distinct values (four bytes a value), grows
some of the trees and writes them; only importances and node counts reach the driver. Scoring reads the trees back one at a time.

Every tree is that of the textbook: ``n`` rows drawn with replacement, a random choice of features at every node (more while all of
them are constant there), and the best of all cuts between the values that the node's rows have, by variance, which for labels 0 and
1 is the Gini impurity. Nothing is binned and no cut comes from a sample. Rows are ordered by their content and random numbers are
keyed by seed, tree and level, so the trees do not depend on how rows and trees are dealt; a lower depth limit or fewer trees are a
part of a larger forest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession, functions as F

from wavelattice.session import files_at, remove_path, scratch_path

#: Rows up to which a task holds the whole table (ranks of 25 features are 200 MB there, and a sort key fits in 63 bits).
MOST_ROWS = 2_000_000
#: Tasks that the trees of a forest are dealt to, and rows that a task scores per pass over the trees.
TASKS, SCORED = 24, 1 << 16

_TREES = pa.schema([("tree", pa.int32()), ("nodes", pa.int64()), ("importance", pa.list_(pa.float64())), ("feature", pa.binary()),
                    ("cut", pa.binary()), ("left", pa.binary()), ("value", pa.binary()), ("cover", pa.binary())])
_TREES_DDL = "tree int, nodes bigint, importance array<double>, feature binary, cut binary, left binary, value binary, cover binary"


@dataclass(frozen=True)
class Rows:
    """Written train rows: columns ``x0, x1, ..., label, weight, fold``."""

    path: str
    width: int
    n: int
    classes: bool


def written(ready: DataFrame, classes: bool) -> Rows:
    """``features, label`` and optionally ``weight, fold`` of ``ready`` in the shared folder; labels are checked."""
    spark, path = ready.sparkSession, scratch_path(ready.sparkSession, "forest-rows")
    width = ready.schema["features"].metadata.get("ml_attr", {}).get("num_attrs")
    if not width:
        first = ready.select("features").first()
        width = len(first[0]) if first else 0
    x = vector_to_array("features")
    label = F.col("label").cast("double")
    weight = F.col("weight").cast("double") if "weight" in ready.columns else F.lit(1.0)
    fold = F.col("fold").cast("int") if "fold" in ready.columns else F.lit(0)
    ready.select(*[x[i].alias(f"x{i}") for i in range(width)], label.alias("label"), weight.alias("weight"), fold.alias("fold")).write.parquet(path)
    sound = F.col("label").isNotNull() & ~F.isnan("label") & ((F.col("label") >= 0) & (F.col("label") == F.floor("label")) if classes else F.lit(True))
    sound = sound & F.col("weight").isNotNull() & (F.col("weight") >= 0)
    seen = spark.read.parquet(path).agg(F.count("*").alias("n"), F.count_if(~F.coalesce(sound, F.lit(False))).alias("bad"), F.max("label").alias("most")).first()
    if seen["bad"] or not seen["n"]:
        raise ValueError(f"a forest needs rows, and labels that are {'class numbers' if classes else 'numbers'}")
    return Rows(path, int(width), seen["n"] if not classes or seen["most"] <= 1 else MOST_ROWS + 1, classes)


def fits(rows: Rows) -> bool:
    """Whether tasks can hold ``rows``, with two classes at most."""
    return rows.n <= MOST_ROWS


def _mixed(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    h = (h ^ bits) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _column(data: ds.Dataset, name: str) -> np.ndarray:
    return data.to_table(columns=[name], use_threads=False).column(0).to_numpy().astype(float)


def _loaded(rows: Rows, without: int | None, columns: Sequence[int]) -> tuple:
    """Ranks by feature and row, labels and weights of the rows that are not in fold ``without``, and the distinct values of a feature."""
    data = ds.dataset(files_at(rows.path)[1], filesystem=files_at(rows.path)[0], format="parquet")
    fold = _column(data, "fold")  # no number is a row of no fold, which every fit learns from
    kept = np.flatnonzero(fold != without) if without is not None else np.arange(len(fold))
    y, w = _column(data, "label")[kept], _column(data, "weight")[kept]
    if not len(y):
        raise ValueError("a forest needs rows")
    ranks, h = np.empty((len(columns), len(y)), np.int32), _mixed(_mixed(np.zeros(len(y), np.uint64), y.view(np.uint64)), w.view(np.uint64))
    for i, c in enumerate(columns):
        ranks[i] = np.unique(_column(data, f"x{c}")[kept], return_inverse=True)[1]
        h = _mixed(h, ranks[i].astype(np.uint64))
    order = np.argsort(h, kind="stable")  # by content, the same wherever the rows were
    for i in range(len(columns)):
        ranks[i] = ranks[i][order]
    return ranks, y[order], w[order], lambda i: np.unique(_column(data, f"x{columns[i]}")[kept])


def _best_cuts(ranks, order, row, node, weight, target, count, sums, leaf: int, tries: int) -> tuple:
    """``gain, feature, rank left of the cut, rank right of it`` of the best cut of every node; feature -1 where there is none."""
    w, t, s, c = sums
    k, d = order.shape
    whole = t * t / w
    best, feature = 1e-12 * s, np.full(k, -1, np.int32)
    below, above = np.zeros(k, np.int32), np.zeros(k, np.int32)
    varies = np.zeros(k, bool)
    row_bits, rank_bits = max(1, int(len(row) - 1).bit_length()), max(1, int(ranks.max()).bit_length())
    for j in range(d):
        at = None
        if j >= tries:  # like a feature that does not vary was not drawn, until one does
            if varies.all():
                break
            at = np.flatnonzero(~varies[node])
        n_at, r_at = (node, row) if at is None else (node[at], row[at])
        key = (((n_at << rank_bits) | ranks[order[n_at, j], r_at]) << row_bits) | np.arange(len(n_at))
        key.sort()
        place = key & ((1 << row_bits) - 1)
        place = place if at is None else at[place]
        key >>= row_bits
        own = key >> rank_bits
        edge = own[1:] != own[:-1]
        cuts = np.flatnonzero((key[1:] != key[:-1]) & ~edge)
        if not len(cuts):
            continue
        starts = np.concatenate([[0], np.flatnonzero(edge) + 1])
        first = np.zeros(k, np.int64)
        first[own[starts]] = starts
        of = own[cuts]
        varies[of] = True

        def left(v):
            total = np.cumsum(v[place])
            return total[cuts] - np.where(first[of] > 0, total[first[of] - 1], 0.0)

        lw, lt = left(weight), left(target)
        rw, rt = w[of] - lw, t[of] - lt
        gain = lt * lt / lw + rt * rt / rw - whole[of]
        gain[(lw <= 0) | (rw <= 0)] = -np.inf
        if leaf > 1:
            lc = left(count)
            gain[(lc < leaf) | (c[of] - lc < leaf)] = -np.inf
        runs = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        most = np.maximum.reduceat(gain, runs)
        hit = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(runs, len(of)))))
        hit = hit[np.concatenate([[True], of[hit[1:]] != of[hit[:-1]]])]
        hit = hit[gain[hit] > best[of[hit]]]
        to, mask = of[hit], (1 << rank_bits) - 1
        best[to], feature[to] = gain[hit], order[to, j]
        below[to], above[to] = key[cuts[hit]] & mask, key[cuts[hit] + 1] & mask
    return best, feature, below, above


def grown_tree(ranks: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, leaf: int, tries: int, seed: int, number: int) -> tuple:
    """Arrays ``feature, below, above, left, value, cover, gain`` of the nodes of one tree by level; a cut is between two ranks.

    An inner node's children are ``left`` and ``left + 1``, a leaf's feature is -1.
    """
    d, n = ranks.shape
    times = np.bincount(np.random.default_rng((seed, number)).integers(0, n, n), minlength=n)
    row = np.flatnonzero((times > 0) & (w > 0))
    if not len(row):
        row, times = np.arange(n), np.ones(n, np.int64)
        w = np.where(w.any(), w, 1.0)
    count = times[row].astype(float)
    centre = float(np.average(y, weights=w)) if not np.isin(y, (0.0, 1.0)).all() else 0.0
    weight = w[row] * count
    target = weight * (y[row] - centre)
    square = target * (y[row] - centre)
    node, done, out = np.zeros(len(row), np.int64), 0, []
    for level in range(depth + 1):
        m = int(node.max()) + 1
        w_, t_, s_, c_ = (np.bincount(node, v, m) for v in (weight, target, square, count))
        feature, below, above, child, gain = np.full(m, -1, np.int32), np.zeros(m, np.int32), np.zeros(m, np.int32), np.zeros(m, np.int32), np.zeros(m)
        out.append((feature, below, above, child, t_ / w_ + centre, w_, gain))
        done += m
        ids = np.flatnonzero((c_ >= 2 * leaf) & (s_ - t_ * t_ / w_ > 1e-12 * s_)) if level < depth else []
        if not len(ids):
            break
        slot = np.full(m, -1)
        slot[ids] = np.arange(len(ids))
        keep = slot[node] >= 0
        if not keep.all():
            row, node, weight, target, square, count = (v[keep] for v in (row, node, weight, target, square, count))
        node = slot[node]
        order = np.random.default_rng((seed, number, level)).random((m, d))[ids].argsort(axis=1)
        found = _best_cuts(ranks, order, row, node, weight, target, count, tuple(v[ids] for v in (w_, t_, s_, c_)), leaf, tries)
        cut = np.flatnonzero(found[1] >= 0)
        if not len(cut):
            break
        gain[ids[cut]], feature[ids[cut]], below[ids[cut]], above[ids[cut]] = (f[cut] for f in found)
        child[ids[cut]] = done + 2 * np.arange(len(cut))
        slot = np.full(len(ids), -1)
        slot[cut] = np.arange(len(cut))
        keep = slot[node] >= 0
        if not keep.all():
            row, node, weight, target, square, count = (v[keep] for v in (row, node, weight, target, square, count))
        node = 2 * slot[node] + (ranks[found[1][node], row] > found[2][node])
    return tuple(np.concatenate(v) for v in zip(*out))


def _grown(rows: Rows, without: int | None, columns: Sequence[int], depth: int, leaf: int, tries: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = [i for b in batches for i in b.column(0).to_pylist()]
        if not numbers:
            return
        ranks, y, w, values = _loaded(rows, without, columns)
        trees = [grown_tree(ranks, y, w, depth, leaf, tries, seed, i) for i in numbers]
        del ranks, y, w
        cuts = [np.zeros(len(t[0])) for t in trees]
        for f in range(len(columns)):
            used = [np.flatnonzero(t[0] == f) for t in trees]
            if any(len(u) for u in used):
                v = values(f)
                for cut, t, u in zip(cuts, trees, used):
                    lo, hi = v[t[1][u]], v[t[2][u]]
                    with np.errstate(invalid="ignore", over="ignore"):
                        middle = lo + (hi - lo) / 2.0
                    cut[u] = np.where((middle >= lo) & (middle < hi), middle, lo)
        for i, cut, t in zip(numbers, cuts, trees):
            gains = np.bincount(t[0][t[0] >= 0], t[6][t[0] >= 0], len(columns))
            gains = gains / gains.sum() if gains.sum() > 0 else gains
            packed = [a.tobytes() for a in (t[0], cut, t[3], t[4], t[5])]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([i, len(cut), gains.tolist(), *packed], _TREES)], schema=_TREES)
    return run


def trees_of(row: dict) -> tuple:
    """``feature, cut, left, value, cover`` of a written tree."""
    kinds = {"feature": np.int32, "cut": np.float64, "left": np.int32, "value": np.float64, "cover": np.float64}
    return tuple(np.frombuffer(row[name], kind) for name, kind in kinds.items())


def placed(x: np.ndarray, tree: tuple, depth: int | None = None) -> np.ndarray:
    """The node of every row after at most ``depth`` steps down ``tree``."""
    feature, cut, left = tree[:3]
    at, going = np.zeros(len(x), np.int32), np.arange(len(x))
    while len(going) and depth != 0:
        here = at[going]
        f = feature[here]
        if f.min() < 0:
            going, here, f = going[f >= 0], here[f >= 0], f[f >= 0]
        at[going] = left[here] + (x[going, f] > cut[here])
        depth = depth - 1 if depth is not None else None
    return at


@dataclass
class Forest:
    """A fitted forest: adds ``prediction``, and ``probability`` for a classifier, to rows with ``features``.

    ``trees`` and ``depth`` may be fewer than were grown.
    """

    spark: SparkSession
    path: str
    width: int
    trees: int
    classes: bool
    depth: int | None = None
    prediction: str = "prediction"

    @property
    def numFeatures(self) -> int:
        return self.width

    @property
    def getNumTrees(self) -> int:
        return self.trees

    def table(self) -> DataFrame:
        """The trees, a row each (see :func:`trees_of`)."""
        return self.spark.read.parquet(self.path).where(F.col("tree") < self.trees)

    @property
    def totalNumNodes(self) -> int:
        return self.table().agg(F.sum("nodes")).first()[0]

    @property
    def featureImportances(self) -> DenseVector:
        """Mean share of the features in the impurity that each tree takes away."""
        found = np.array([r["importance"] for r in self.table().orderBy("tree").select("importance").collect()]).sum(axis=0)  # a row per tree
        return DenseVector(found / found.sum() if found.sum() > 0 else found)

    def first(self, trees: int) -> "Forest":
        """The forest of the first ``trees`` trees."""
        return replace(self, trees=min(trees, self.trees))

    def to_depth(self, depth: int) -> "Forest":
        """The forest that a fit with a lower depth limit gives."""
        return replace(self, depth=depth)

    def setPredictionCol(self, name: str) -> "Forest":
        self.prediction = name
        return self

    def forget(self) -> None:
        """Delete the written trees."""
        remove_path(self.spark, self.path)

    def transform(self, df: DataFrame) -> DataFrame:
        path, trees, depth, width = self.path, self.trees, self.depth, self.width

        def scored(batches: list[pa.Array]) -> Iterator[pa.Array]:
            x = np.concatenate([b.flatten().to_numpy(zero_copy_only=False).reshape(len(b), width) for b in batches])
            where, inner = files_at(path)
            out = np.zeros(len(x))
            read = ds.dataset(inner, filesystem=where, format="parquet").to_batches(
                columns=["tree", "feature", "cut", "left", "value", "cover"], filter=ds.field("tree") < trees, batch_size=1, batch_readahead=0,
                fragment_readahead=0, use_threads=False)
            for batch in read:
                for row in batch.to_pylist():
                    tree = trees_of(row)
                    out += tree[3][placed(x, tree, depth)]
            at = np.cumsum([0] + [len(b) for b in batches])
            yield from (pa.array(out[i:j] / trees) for i, j in zip(at, at[1:]))

        @F.arrow_udf("double")
        def mean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            held, n = [], 0
            for batch in batches:
                held.append(batch)
                n += len(batch)
                if n >= SCORED:
                    yield from scored(held)
                    held, n = [], 0
            if held:
                yield from scored(held)

        score = mean(vector_to_array("features"))
        if not self.classes:
            return df.withColumn(self.prediction, score)
        p = F.col("_share")
        return df.withColumn("_share", score).withColumn("probability", array_to_vector(F.array(1.0 - p, p))).withColumn(
            self.prediction, (p > 0.5).cast("double")).drop("_share")


def grow(spark: SparkSession, rows: Rows, trees: int, depth: int, leaf: int, tries: int, seed: int, without: int | None = None,
         columns: Sequence[int] | None = None) -> Forest:
    """A forest of ``trees`` trees on ``rows`` without fold ``without``, from the given feature numbers (all by default)."""
    columns, path = list(range(rows.width) if columns is None else columns), scratch_path(spark, "forest")
    spark.range(0, trees, 1, min(TASKS, trees)).mapInArrow(_grown(rows, without, columns, depth, leaf, tries, seed), _TREES_DDL).write.parquet(path)
    return Forest(spark, path, len(columns), trees, rows.classes)
