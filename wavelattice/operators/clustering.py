"""Clustering and cluster quality."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from wavelattice import schema as S
from wavelattice.operators import neighbors as N
from wavelattice.operators.graph import star_components
from wavelattice.operators.grid import build_grid
from wavelattice.operators.profiling import centred_moments
from wavelattice.operators.quantiles import prefix_sums
from wavelattice.operators.skew import join_facts
from wavelattice.operators.splits import apply_scaling, sampled_subset, scaler_statistics
from wavelattice.session import concurrently, fresh_cut


def kmeans_fit(df: DataFrame, columns: Sequence[str], k: int | Sequence[int], restarts: int = 10,
               seed: int = S.SEED, parallelism: int = 8):
    """Centres and cost of the best of several seeded k-means runs.

    For a list of ``k`` the result is a dict. The runs are independent Spark jobs over one cached
    input and are submitted from ``parallelism`` driver threads, as Spark's cross-validator does.
    """
    ks = [k] if isinstance(k, int) else list(k)
    data = VectorAssembler(inputCols=list(columns), outputCol="features").transform(df).select("features")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)

    def run(task):
        n, r = task
        model = KMeans(k=n, seed=seed + r, maxIter=300, tol=1e-4).fit(data)
        return n, r, np.array(model.clusterCenters()), model.summary.trainingCost

    done = concurrently(df.sparkSession, run, [(n, r) for n in ks for r in range(restarts)], parallelism)
    data.unpersist()
    best = {}
    for n, r, centres, cost in done:
        if n not in best or cost < best[n][1]:
            best[n] = (centres, cost)
    return best[k] if isinstance(k, int) else best


def kmeans_assign(df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``cluster`` (nearest centre, first on ties) and ``dist2``.

    The distances are plain column arithmetic, so the assignment stays inside generated code.
    """
    columns = list(columns)
    terms = []
    for centre in centres:
        d = F.lit(0.0)
        for c, v in zip(columns, centre):
            diff = F.col(c) - F.lit(float(v))
            d = d + diff * diff
        terms.append(d)
    measured = df.withColumn("_d", F.array(*terms)).withColumn("dist2", F.array_min("_d"))
    return measured.withColumn("cluster", (F.array_position("_d", F.col("dist2")) - 1).cast("int")).drop("_d")


def kmeans_assign_all(df: DataFrame, columns: Sequence[str], centres: dict[str, Sequence[Sequence[float]]]) -> DataFrame:
    """Add ``<name>, cost<name>`` for several sets of centres: what :func:`kmeans_assign` gives as ``cluster, dist2`` for each.

    One Arrow function measures all of them. As column arithmetic the plan would have a term per column and centre, which the driver
    analyses, generates code for and compiles anew in every job.
    """
    columns, sets = list(columns), [np.array(c, float) for c in centres.values()]

    @F.arrow_udf("array<double>")
    def nearest(x: pa.Array) -> pa.Array:
        v = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(columns))
        out = np.empty((len(x), 2 * len(sets)))
        for j, c in enumerate(sets):
            d = np.zeros((len(x), len(c)))
            for i in range(len(columns)):  # added up in the order of the columns
                diff = v[:, i, None] - c[None, :, i]
                d += diff * diff
            out[:, 2 * j], out[:, 2 * j + 1] = d.argmin(axis=1), d.min(axis=1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))

    found = fresh_cut(df.withColumn("_near", nearest(F.array(*[F.col(c).cast("double") for c in columns]))))
    return found.withColumns({k: v for j, name in enumerate(centres) for k, v in (
        (name, F.col("_near")[2 * j].cast("int")), (f"cost{name}", F.col("_near")[2 * j + 1]))}).drop("_near")


def inertia(assigned: DataFrame) -> DataFrame:
    """Sum of squared distances to the assigned centres."""
    return assigned.agg(F.sum("dist2").alias("inertia"), F.count("*").alias("n"))


def cluster_label_map(test: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Accuracy of clusters 0/1 as labels, as they are and flipped; ``flip`` when that is better."""
    a = F.avg((F.col(cluster) == F.col(label)).cast("double"))
    b = F.avg(((1 - F.col(cluster)) == F.col(label)).cast("double"))
    return test.agg(a.alias("acc_identity"), b.alias("acc_flipped"), (b > a).cast("int").alias("flip"),
                    F.greatest(a, b).alias("best_acc"))


def apply_label_map(df: DataFrame, mapping: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Clusters renamed by the one-row result of :func:`cluster_label_map`."""
    flag = F.broadcast(mapping.select(F.col("flip").alias("_flip")))
    return df.join(flag).withColumn(
        cluster, F.when(F.col("_flip") == 1, 1 - F.col(cluster)).otherwise(F.col(cluster))).drop("_flip")


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings, from their contingency counts."""
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").cast("double").alias("n"))

    def pairs(c):
        return c * (c - 1) / 2

    rows = cells.groupBy("a").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("sa"),
                                                             F.sum("n").alias("n"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("sb"))
    both = cells.agg(F.sum(pairs(F.col("n"))).alias("sab"))
    one = rows.join(F.broadcast(cols)).join(F.broadcast(both))  # single rows
    expected = F.try_divide(F.col("sa") * F.col("sb"), pairs(F.col("n")))
    top = (F.col("sa") + F.col("sb")) / 2
    return one.select(F.when(top == expected, F.lit(1.0)).otherwise(
        F.try_divide(F.col("sab") - expected, top - expected)).alias("ari"))


def silhouette_values(df: DataFrame, key: str, vec: str, clusters: Sequence[str]) -> DataFrame:
    """``labeling, key, s``: exact Euclidean silhouette of every row under one or more labelings.

    The definition needs all distances, so the cost is quadratic; the rows are cut into chunks and
    every pair of chunks is one task that returns distance sums per (labeling, row, cluster). The
    distances are computed once for both rows of a pair and for all labelings. Use ``sample_size`` of :func:`silhouette` for
    large tables, as the evaluation protocol does.
    """
    names = list(clusters)
    rows = df.select(F.col(key).cast("long").alias("pt"), F.col(vec).cast("array<double>").alias("vec"),
                     F.array(*[F.col(c).cast("int") for c in names]).alias("own"))
    rows = fresh_cut(rows)
    total = rows.count()
    chunks = max(1, -(-total // N.block_side(total * total / 2)))

    def members(own: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The clusters of every labeling, and which of them every row is in."""
        found, parts = [], []
        for j in range(len(names)):
            values, code = np.unique(own[:, j], return_inverse=True)
            found.append(values)
            parts.append((code[:, None] == np.arange(len(values))).astype(float))
        return found, np.hstack(parts)

    def sums_of(pt: np.ndarray, mine: np.ndarray, found: list[np.ndarray], totals: np.ndarray, sizes: np.ndarray) -> list[tuple]:
        out, at = [], 0
        for j, values in enumerate(found):
            k = len(values)
            out.append((np.full(len(pt) * k, j, np.int32), np.repeat(pt, k), np.repeat(mine[:, j], k).astype(np.int32),
                        np.tile(values, len(pt)).astype(np.int32), totals[:, at:at + k].ravel(), np.tile(sizes[at:at + k].astype(np.int64), len(pt))))
            at += k
        return out

    def block(pair, both):
        """Sums of the rows of two chunks towards the clusters of the other, from distances computed once."""
        same = pair[0].as_py() == pair[1].as_py()
        right = both.column("_right").to_numpy(zero_copy_only=False)
        left, other = (both, both) if same else (both.filter(pa.array(~right)), both.filter(pa.array(right)))
        out = [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64))]
        if left.num_rows and other.num_rows:
            a, b = N.matrix(left, "own"), N.matrix(other, "own")
            (found_a, in_a), (found_b, in_b) = members(a), members(b)
            from_a, from_b = np.empty((len(a), in_b.shape[1])), np.zeros((len(b), in_a.shape[1]))
            for at, d in N.distances(N.matrix(left), N.matrix(other)):
                from_a[at] = d @ in_b
                if not same:
                    from_b += d.T @ in_a[at]
            out += sums_of(N.numbers(left, "pt"), a, found_b, from_a, in_b.sum(axis=0))
            if not same:
                out += sums_of(N.numbers(other, "pt"), b, found_a, from_b, in_a.sum(axis=0))
        return pa.table(dict(zip(("labeling", "pt", "own", "other", "total", "n"), map(np.concatenate, zip(*out)))))

    mine, other = F.col("_mine"), F.col("_other")
    dealt = (rows.withColumn("_mine", F.pmod(F.xxhash64("pt"), F.lit(chunks)).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    dealt = dealt.select("pt", "vec", "own", F.least(mine, other).alias("_a"), F.greatest(mine, other).alias("_b"), (mine > other).alias("_right"))
    sums = dealt.groupBy("_a", "_b").applyInArrow(block, "labeling int, pt long, own int, other int, total double, n long")
    per = sums.groupBy("labeling", "pt", "own", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    mine = F.col("own") == F.col("other")
    both = per.groupBy("labeling", "pt").agg(
        F.max(F.when(mine, F.col("n"))).alias("n_own"),
        F.max(F.when(mine & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~mine, F.col("total") / F.col("n"))).alias("b"))
    s = F.when(F.col("n_own") == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("labeling") + 1)
    return both.select(name.alias("labeling"), F.col("pt").alias(key), s.alias("s"))


def silhouette(df: DataFrame, key: str, vec: str, clusters: Sequence[str], sample_size: int | None = None,
               seed: int = S.SEED) -> DataFrame:
    """``labeling, silhouette, n``: mean over all rows, or over a reproducible sample of ``sample_size``."""
    rows = df if sample_size is None else sampled_subset(df, key, sample_size, seed)
    return silhouette_values(rows, key, vec, clusters).groupBy("labeling").agg(
        F.avg("s").alias("silhouette"), F.count("*").alias("n"))


def _linear_silhouette(rank: dict, n: np.ndarray, mean: np.ndarray, square: np.ndarray):
    """Arrow function of (vector, cluster) for clusters of size ``n`` with their mean vectors and mean squares."""
    @F.arrow_udf("double")
    def value(vec: pa.Array, own: pa.Array) -> pa.Array:
        v = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), mean.shape[1])
        at = np.array([rank[c] for c in own.to_pylist()], np.int64)
        i = np.arange(len(v))
        d = np.maximum((v * v).sum(axis=1)[:, None] + square - 2 * v @ mean.T, 0.0)
        size = n[at]
        a = d[i, at] * size / np.maximum(size - 1, 1)
        d[i, at] = np.inf
        b = d.min(axis=1)
        lone = (size == 1) | ~np.isfinite(b) | (np.maximum(a, b) == 0)
        return pa.array(np.where(lone, 0.0, (np.where(lone, 0.0, b) - a) / np.where(lone, 1.0, np.maximum(a, b))))

    return value


def silhouette_squared(df: DataFrame, columns: Sequence[str], clusters: Sequence[str]) -> DataFrame:
    """``labeling, silhouette, n``: silhouette under squared Euclidean distance, at a cost linear in the rows.

    The mean squared distance of a row to a cluster follows from the cluster's size, vector sum and sum of squares, so one
    aggregate of one row per cluster and one scan are all. One vector per cluster reaches the driver, as with centres.
    """
    columns = list(columns)
    out = None
    for name in clusters:
        x = [F.col(c).cast("double") for c in columns]
        stats = df.groupBy(F.col(name).cast("int").alias("c")).agg(
            F.count("*").alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"), F.sum(sum((v * v for v in x), F.lit(0.0))).alias("q")).collect()
        rank = {r["c"]: i for i, r in enumerate(stats)}
        n = np.array([r["n"] for r in stats], float)
        mean = np.array([r["s"] for r in stats], float).reshape(len(stats), len(columns)) / n[:, None] if len(stats) else np.zeros((0, len(columns)))
        square = np.array([r["q"] for r in stats], float) / n

        s = _linear_silhouette(rank, n, mean, square)(F.array(*x), F.col(name).cast("int"))
        part = df.select(F.lit(name).alias("labeling"), s.alias("s"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("labeling").agg(F.avg("s").alias("silhouette"), F.count("*").alias("n"))


def elbow_silhouette(train: DataFrame, key: str, columns: Sequence[str], ks: Sequence[int] = tuple(range(2, 11)),
                     sample_size: int | None = None, restarts: int = 10, seed: int = S.SEED) -> DataFrame:
    """``k, inertia, silhouette, n`` for several k, fitted and costed on all scaled rows.

    The silhouette is taken over all rows, or over a reproducible sample of ``sample_size``, as it costs a distance per pair
    of rows; ``n`` says over how many. The assignments of all k are columns of one table, so costs and distances
    are each computed in one pass.
    """
    columns = list(columns)
    scaled = apply_scaling(train, scaler_statistics(train, columns))
    wide = fresh_cut(scaled.select(key, *columns))
    found = {f"k{k}": centres for k, (centres, _) in kmeans_fit(wide, columns, list(ks), restarts, seed).items()}
    wide = kmeans_assign_all(wide.select(key, *columns, F.array(*columns).alias("vec")), columns, found).drop(*columns)
    costs = wide.agg(*[F.sum(f"costk{k}").alias(f"k{k}") for k in ks]).unpivot(
        [], [f"k{k}" for k in ks], "labeling", "inertia")
    quality = silhouette(wide, key, "vec", [f"k{k}" for k in ks], sample_size, seed)
    return costs.join(quality, "labeling").select(
        F.substring("labeling", 2, 9).cast("int").alias("k"), "inertia", "silhouette", "n")


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Population covariance as a matrix; ``len(columns)`` squared numbers reach the driver."""
    columns = list(columns)
    at = {c: i for i, c in enumerate(columns)}
    out = np.zeros((len(columns), len(columns)))
    for r in centred_moments(df, columns).collect():
        out[at[r["a"]], at[r["b"]]] = out[at[r["b"]], at[r["a"]]] = r["cov"]
    return out


def pca_fit(df: DataFrame, columns: Sequence[str], components: int = 2) -> dict:
    """Mean, loadings (largest entry of each positive) and explained variance ratios.

    The covariance is one distributed aggregate; only its d x d eigenproblem is solved locally.
    """
    columns = list(columns)
    mean = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    values, vectors = np.linalg.eigh(covariance_matrix(df, columns))
    order = np.argsort(values)[::-1][:components]
    loadings = vectors[:, order]
    loadings = loadings * np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(components)])
    return {"columns": columns, "mean": [mean[c] for c in columns], "loadings": loadings,
            "explained": values[order] / values.sum()}


def pca_project(df: DataFrame, model: dict) -> DataFrame:
    """Add ``pc1, pc2, ...`` of centred rows."""
    out = {}
    for j in range(model["loadings"].shape[1]):
        score = F.lit(0.0)
        for c, m, w in zip(model["columns"], model["mean"], model["loadings"][:, j]):
            score = score + (F.col(c) - F.lit(float(m))) * F.lit(float(w))
        out[f"pc{j + 1}"] = score
    return df.withColumns(out)


def _forest(left: pa.Table, right: pa.Table, limit: float) -> pa.Table:
    """Spanning stars of the "within eps" graph of two blocks: one edge per point."""
    near = np.concatenate([some for _, some in N.within(N.matrix(left), N.matrix(right), limit)])
    u, v = N.numbers(left, "pt"), N.numbers(right, "pt")
    a, b = u.copy(), v.copy()
    open_a, open_b = np.ones(len(u), bool), np.ones(len(v), bool)
    for i in range(len(u)):
        if not open_a[i]:
            continue
        open_a[i], edge = False, np.array([i])
        while len(edge):  # breadth first; every row and column is read once
            reached = np.flatnonzero(near[edge].any(axis=0) & open_b)
            open_b[reached], b[reached] = False, u[i]
            edge = np.flatnonzero(near[:, reached].any(axis=1) & open_a) if len(reached) else reached
            open_a[edge], a[edge] = False, u[i]
    return pa.table({"u": np.concatenate([u, v]), "v": np.concatenate([a, b])})


def dbscan(df: DataFrame, key: str, vec: str, eps: float = 2.0, min_samples: int = 10) -> DataFrame:
    """``key, cluster``: density clusters, numbered by their smallest core key; -1 is noise.

    A core row has at least ``min_samples`` rows (itself included) within ``eps``. Core points
    within ``eps`` of each other share a cluster; a non-core row joins the lowest-numbered cluster
    that has a core row within ``eps``. Neighbours come from a projection grid of bins as wide as ``eps``.
    """
    rows = N.vectors_of(df, key, vec)
    grid = build_grid(N.collapse_copies(rows, key, "vec"), eps)
    counted = N.eps_neighbor_counts(grid.points, grid.visiting(grid.points.select("pt", "vec", "cell")), eps)
    pts = fresh_cut(grid.points.select("pt", "vec", "weight", "cell").join(
        counted.select("pt", (F.col("n_near") >= min_samples).alias("core")), "pt"))
    core = pts.filter("core").select("pt", "vec", "cell")
    limit = eps * eps
    edges = N.compare_blocks(grid.visiting(core), core, lambda q, c: _forest(q, c, limit), "u long, v long")
    comps = star_components(core.select(F.col("pt").alias("node")), edges)
    labelled = core.join(comps, F.col("pt") == F.col("node")).select("pt", "vec", "cell", "comp")

    def lowest(q: pa.Table, c: pa.Table) -> pa.Table:
        top = np.iinfo(np.int64).max
        comp = np.concatenate([np.where(near, N.numbers(c, "comp")[None, :], top).min(axis=1)
                               for _, near in N.within(N.matrix(q), N.matrix(c), limit)])
        hit = comp < top
        return pa.table({"pt": N.numbers(q, "pt")[hit], "comp": comp[hit]})

    border = pts.filter(~F.col("core")).select("pt", "vec", "cell")
    joined = N.compare_blocks(grid.visiting(border), labelled, lowest, "pt long, comp long").groupBy("pt").agg(F.min("comp").alias("comp"))
    roots = comps.filter(F.col("node") == F.col("comp")).select(F.col("node").alias("root"), F.lit(1).alias("one"))
    order = prefix_sums(roots, [], "root", ["one"]).select(F.col("root").alias("comp"), (F.col("cum_one") - 1).cast("int").alias("cluster"))
    placed = fresh_cut(labelled.select("pt", "comp").unionByName(joined))
    sizes = placed.groupBy("comp").agg(F.count("*").alias("n"))
    known = join_facts(placed, sizes.join(order, "comp"), "comp", "n", "pt").select("pt", "cluster")
    facts = fresh_cut(pts.join(known, "pt", "left").select("vec", "weight", F.coalesce("cluster", F.lit(-1)).alias("cluster")))
    return join_facts(rows, facts, "vec", "weight", key, narrow=False).select(key, "cluster")


def distinct_labels(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Number of clusters without noise, and the number and share of noise rows."""
    noise = F.col(cluster) == -1
    return df.agg(F.countDistinct(F.when(~noise, F.col(cluster))).alias("n_clusters"),
                  F.count_if(noise).alias("n_noise"), F.count("*").alias("n"))


def dbscan_accuracy(df: DataFrame, label: str, cluster: str = "cluster") -> DataFrame:
    """Accuracy over non-noise rows with raw cluster numbers as labels, and by majority vote.

    The first follows the established definition: clusters beyond 1 always count as wrong, and the
    value is 0 unless there are two clusters. The second gives each cluster its commonest label.
    """
    counts = (df.filter(F.col(cluster) != -1).groupBy(F.col(cluster).alias("c"), F.col(label).alias("y"))
              .agg(F.count("*").alias("n")))
    best = counts.groupBy("c").agg(F.max("n").alias("top"), F.sum("n").alias("n"),
                                   F.sum(F.when(F.col("c") == F.col("y"), F.col("n")).otherwise(0)).alias("same"),
                                   F.sum(F.when(1 - F.col("c") == F.col("y"), F.col("n")).otherwise(0)).alias("flip"))
    enough = F.count("*") >= 2
    return best.agg(
        F.when(enough, F.greatest(F.sum("same"), F.sum("flip")) / F.sum("n")).otherwise(F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.sum("top") / F.sum("n"), F.lit(0.0)).alias("majority_accuracy"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_clustered"))
