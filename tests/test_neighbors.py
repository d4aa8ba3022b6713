"""Neighbour operators against brute force, with many copies and many small cells and chunks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavelattice.operators import augment, clustering, graph, grid, lsh, neighbors, skew


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(2)
    p = np.concatenate([rng.normal(0, 0.4, (60, 3)), rng.normal(3, 0.5, (50, 3)), rng.uniform(-6, 9, (20, 3)),
                        np.tile([[0.1, 0.1, 0.1]], (65, 1))])  # a third are copies
    ids = rng.permutation(len(p))
    df = spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, p)], "id long, vec array<double>")
    order = np.argsort(ids)
    return df.repartition(5).cache(), p[order]


@pytest.fixture(autouse=True)
def tiny_blocks(monkeypatch):
    monkeypatch.setattr(neighbors, "CHUNK", 9)
    monkeypatch.setattr(neighbors, "CELL_TARGET", 12)


def blocks():
    """Pairs of blocks: spread, far from the origin, on a lattice with many equal distances, of mixed scales, without spread, not finite."""
    rng = np.random.default_rng(4)
    v = rng.normal(size=(700, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    scales = 10.0 ** rng.integers(-30, 9, (700, 1))
    odd = v[:60].copy()
    odd[3, 2], odd[5, 1] = np.nan, np.inf
    return {"spread": (v[:600], v[500:]), "far": (v[:300] + 1e6, v[300:] + 1e6), "lattice": (np.round(v[:300, :3] * 8) / 4 + 1e3, np.round(v[:, :3] * 8) / 4 + 1e3),
            "mixed": (v[:300] * scales[:300], v * scales), "equal": (np.zeros((5, 3)), np.zeros((4, 3))), "odd": (odd, v[:50])}


@pytest.mark.parametrize("name", list(blocks()))
@pytest.mark.filterwarnings("ignore::RuntimeWarning")
def test_products_lose_no_pair(name):
    a, b = blocks()[name]
    d = neighbors.squared_distances(a, b)
    some = np.sort(d[np.isfinite(d)])
    for limit in (some[len(some) // 3], some[7], np.nextafter(some[7], -1)):
        near = np.concatenate([x for _, x in neighbors.within(a, b, float(limit))])
        assert (near == (d <= limit)).all()
    for limit in (np.inf, some[len(some) // 50]):
        row, col, found = neighbors.nearest_pairs(a, b, 3, np.full(len(a), float(limit)))
        assert (found == d[row, col]).all() and len(set(zip(row, col))) == len(row)
        kth = np.sort(d, axis=1)[:, 2]
        want = set(zip(*np.nonzero((d <= kth[:, None]) & (d <= limit))))
        assert want <= set(zip(row, col))
    if name != "odd":
        got = np.concatenate([x for _, x in neighbors.distances(a, b)])
        assert np.abs(got - np.sqrt(d)).max() <= 1e-10 * np.sqrt(d).max()


def test_large_blocks_are_not_measured_pair_by_pair(monkeypatch):
    a, b = blocks()["spread"]
    monkeypatch.setattr(neighbors, "squared_distances", None)
    measured = []
    plain = neighbors.pair_distances
    monkeypatch.setattr(neighbors, "pair_distances", lambda a, b, row, col: measured.append(len(row)) or plain(a, b, row, col))
    for _ in neighbors.within(a, b, 1.4), neighbors.distances(a, b):
        list(_)
    neighbors.nearest_pairs(a, b, 3, np.full(len(a), np.inf))
    assert sum(measured) < 0.05 * len(a) * len(b)


def test_blocks_grow_with_the_comparison():
    sides = [neighbors.block_side(n * n) for n in (10, 140, 2000, 10 ** 6)]
    assert sides[:2] == [neighbors.CHUNK] * 2 and sides[2] == sides[3] == neighbors.WIDEST * neighbors.CHUNK


def distances(p):
    return np.sqrt(((p[:, None] - p[None]) ** 2).sum(axis=2))


@pytest.mark.parametrize("k", [1, 5])
def test_knn(points, k):
    df, p = points
    d = distances(p)
    got = {}
    for r in neighbors.knn(df, "id", "vec", k).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbor"], r["distance"]))
    assert len(got) == len(p)
    for i, found in got.items():
        want = sorted((round(d[i, j], 12), j) for j in range(len(p)) if j != i)[:k]
        found.sort()
        assert [n for _, n, _ in found] == [j for _, j in want]
        assert [x for _, _, x in found] == pytest.approx([x for x, _ in want])


@pytest.fixture
def deep_cells(monkeypatch):
    monkeypatch.setattr(neighbors, "MAX_PIVOTS", 2)
    monkeypatch.setattr(neighbors, "FAN", 4)


def test_cells_are_split_until_small(spark, points, deep_cells):
    df, p = points
    cells = neighbors.build_cells(neighbors.collapse_copies(df, "id", "vec", 4), 4)
    rows = cells.points.collect()
    sizes = {}
    for r in rows:
        sizes[r["cell"]] = sizes.get(r["cell"], 0) + 1
    assert len(cells.levels) >= 2 and max(sizes.values()) <= 2 * neighbors.CELL_TARGET and len(rows) == len(np.unique(p, axis=0))
    facts = {c: (rad, reach) for level in cells.levels for r in level.collect() for c, rad, reach in zip(r["cells"], r["radiuss"], r["reachs"])}
    for r in rows:
        if r["cell"] in facts:
            assert r["own"] <= facts[r["cell"]][0] + 1e-12
            own = sorted(x["own"] for x in rows if x["cell"] == r["cell"])
            assert facts[r["cell"]][1] == pytest.approx(own[3] if len(own) >= 4 else np.inf)


def test_knn_through_deep_cells(points, deep_cells):
    test_knn(points, 3)


def test_cells_on_many_dimensions(spark, deep_cells):
    rng = np.random.default_rng(8)
    p = rng.normal(size=(90, 64)) * np.r_[np.full(3, 3.0), np.full(61, 0.1)]
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(p)], "id long, vec array<double>")
    cells = neighbors.build_cells(neighbors.collapse_copies(df, "id", "vec"))
    assert cells.points.groupBy("cell").count().agg(F.max("count")).first()[0] <= 2 * neighbors.CELL_TARGET
    test_knn((df, p), 5)


def test_hot_keys_are_spread(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    monkeypatch.setattr(skew, "BROADCAST_FACTS", 0)
    rows = spark.range(400).select("id", F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s")).filter("k <> 'k7'")
    got = skew.join_facts(rows, facts, "k", "n", "id")
    assert got.columns == ["k", "id", "s"]
    want = rows.join(facts, "k").select("k", "id", "s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    outer = skew.join_facts(rows, facts, "k", "n", "id", how="left")
    assert sorted(map(str, outer.collect())) == sorted(map(str, rows.join(facts, "k", "left").select("k", "id", "s").collect()))
    groups = skew.apply_with_facts(rows.withColumn("pt", F.col("id")), facts.select("k", "s"), "k", "pt",
                                   lambda left, right: left.select(["pt"]).append_column("n", [[left.num_rows] * left.num_rows]), "pt long, n long", 20).collect()
    assert sorted(r["pt"] for r in groups) == sorted(r["id"] for r in want.collect()) and max(r["n"] for r in groups) < 60


# --- projection grid

@pytest.mark.parametrize("eps", [0.05, 0.7, 3.0])
def test_eps_neighbors(points, eps):
    df, p = points
    got = {r["id"]: r["n_near"] for r in grid.eps_neighbors(df, "id", "vec", eps).collect()}
    assert [got[i] for i in range(len(p))] == list((distances(p) <= eps).sum(axis=1))


def test_grid_of_lattice_points_at_the_very_radius(spark):
    p = np.array([(x, y, 0.0, z) for x in range(5) for y in range(5) for z in range(5)]) * 0.1 + 1e3
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(p)], "id long, vec array<double>")
    eps = float(np.sqrt(((p[0] - p[1]) ** 2).sum()))
    got = {r["id"]: r["n_near"] for r in grid.eps_neighbors(df, "id", "vec", eps).collect()}
    assert [got[i] for i in range(len(p))] == list((((p[:, None] - p[None]) ** 2).sum(axis=2) <= eps * eps).sum(axis=1))


def test_bins_hold_as_many_points_at_any_size(spark):
    rng = np.random.default_rng(6)
    most = []
    for n in (300, 3000):
        p = rng.uniform(0, (n / 3) ** (1 / 2), (n, 2))
        df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(p)], "id long, vec array<double>")
        g = grid.build_grid(neighbors.collapse_copies(df, "id", "vec"), 1.0)
        most.append((g.points.groupBy("cell").count().agg(F.max("count")).first()[0], g.points.select("cell").distinct().count()))
    assert most[1][0] <= most[0][0] + 8 and most[1][1] > 7 * most[0][1]


def test_nothing_to_search(spark):
    df = spark.createDataFrame([], "id long, vec array<double>")
    assert grid.eps_neighbors(df, "id", "vec", 1.0).collect() == clustering.dbscan(df, "id", "vec").collect() == []
    assert neighbors.knn(df, "id", "vec", 2).collect() == lsh.approx_knn(df, "id", "vec", 2).collect() == []


# --- approximate neighbours

def test_same_bucket_by_simulation():
    rng = np.random.default_rng(1)
    for ratio in (0.3, 1.0, 4.0):
        a, step = rng.uniform(size=200_000), rng.normal(size=200_000) / ratio
        assert lsh.same_bucket(ratio) == pytest.approx((np.floor(a) == np.floor(a + step)).mean(), abs=0.01)


def test_approximate_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(9)
    p = (rng.normal(size=(40, 1, 12)) * 3 + rng.normal(size=(40, 20, 12)) * 0.4).reshape(-1, 12)
    p[::5] = p[1]  # many copies
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(p)], "id long, vec array<double>")
    found = lsh.approx_knn(df, "id", "vec", 4).cache()
    exact = neighbors.knn(df, "id", "vec", 4)
    r = lsh.recall(found, exact, "id").first()
    assert r["recall"] >= 0.9 and r["n_exact"] == 4 * len(p)
    d = distances(p)
    assert all(x["neighbor"] != x["id"] and x["distance"] == pytest.approx(d[x["id"], x["neighbor"]]) for x in found.collect())


# --- components

def test_star_components_equal_the_others(spark):
    rng = np.random.default_rng(12)
    chain = [(i, i + 1) for i in range(1000, 1100)]
    star = [(5000, 5000 + i) for i in range(1, 400)] + [(9000 + i, 9999) for i in range(300)]
    loose = [(int(a), int(b)) for a, b in rng.integers(0, 300, (150, 2))]
    edges = spark.createDataFrame(chain + star + loose + loose[:20] + [(7, 7)], "u long, v long")
    nodes = spark.createDataFrame([(i,) for i in sorted({x for e in chain + star + loose for x in e} | {77777})], "node long")
    want = {r["node"]: r["comp"] for r in graph.connected_components(nodes, edges).collect()}
    assert {r["node"]: r["comp"] for r in graph.star_components(nodes, edges).collect()} == want
    assert graph.star_components(nodes, edges.limit(0)).filter("node <> comp").isEmpty()


def test_large_star_is_spread(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    monkeypatch.setattr(skew, "BROADCAST_FACTS", 0)
    edges = spark.range(1, 20000).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    got = graph.star_components(spark.range(20000).select(F.col("id").alias("node")), edges)
    assert got.filter("comp <> 0").isEmpty() and got.count() == 20000


def test_knn_with_fewer_points_than_asked(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [1.0])], "id long, vec array<double>")
    got = {(r["id"], r["rank"]): r["neighbor"] for r in neighbors.knn(df, "id", "vec", 5).collect()}
    assert got == {(1, 1): 2, (1, 2): 3, (2, 1): 3, (2, 2): 1, (3, 1): 2, (3, 2): 1}


def naive_dbscan(p, eps, m):
    near = ((p[:, None] - p[None]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= m
    label, c = np.full(len(p), -1), 0
    for i in range(len(p)):
        if core[i] and label[i] == -1:
            stack = [i]
            label[i] = c
            while stack:
                for j in np.nonzero(near[stack.pop()])[0]:
                    if label[j] == -1:
                        label[j] = c
                        if core[j]:
                            stack.append(j)
            c += 1
    return label


@pytest.mark.parametrize("eps,m", [(0.3, 5), (0.6, 4), (0.05, 3), (50.0, 3)])
def test_dbscan(points, eps, m):
    df, p = points
    got = {r["id"]: r["cluster"] for r in clustering.dbscan(df, "id", "vec", eps, m).collect()}
    assert [got[i] for i in range(len(p))] == list(naive_dbscan(p, eps, m))


def test_dbscan_accuracy_is_literal(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 1), (2, 1), (-1, 1)], "cluster int, y int")
    r = clustering.dbscan_accuracy(df, "y").first()
    assert (r["accuracy"], r["majority_accuracy"], r["n_clustered"]) == (0.75, 1.0, 4)
    one = clustering.dbscan_accuracy(df.filter("cluster < 1"), "y").first()
    assert one["accuracy"] == 0.0


def test_silhouette(points):
    df, p = points
    label = (p[:, 0] > 1.5).astype(int)
    label[7] = 2  # a cluster of one
    d = distances(p)
    want = []
    for i in range(len(p)):
        own = [j for j in range(len(p)) if label[j] == label[i] and j != i]
        if not own:
            want.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, label == c].mean() for c in set(label) if c != label[i])
        want.append((b - a) / max(a, b))
    lab = F.when(F.col("id") == 7, 2).otherwise((F.col("vec")[0] > 1.5).cast("int"))
    both = df.withColumn("c", lab).withColumn("same", F.lit(0))
    got = {(r["labeling"], r["id"]): r["s"] for r in clustering.silhouette_values(both, "id", "vec", ["c", "same"]).collect()}
    assert [got[("c", i)] for i in range(len(p))] == pytest.approx(want)
    assert set(got[("same", i)] for i in range(len(p))) == {0.0}


def test_silhouette_of_squared_distances(points):
    df, p = points
    label = (p[:, 0] > 1.5).astype(int)
    label[7] = 2
    d = distances(p) ** 2
    want = []
    for i in range(len(p)):
        own = [j for j in range(len(p)) if label[j] == label[i] and j != i]
        a, b = (d[i, own].mean() if own else 0.0), min(d[i, label == c].mean() for c in set(label) if c != label[i])
        want.append((b - a) / max(a, b) if own else 0.0)
    cols = [F.col("vec")[i].alias(f"x{i}") for i in range(p.shape[1])]
    lab = F.when(F.col("id") == 7, 2).otherwise((F.col("vec")[0] > 1.5).cast("int")).alias("c")
    wide = df.select("id", *cols, lab, F.lit(0).alias("same"))
    got = {r["labeling"]: r for r in clustering.silhouette_squared(wide, [f"x{i}" for i in range(p.shape[1])], ["c", "same"]).collect()}
    assert got["c"]["silhouette"] == pytest.approx(np.mean(want)) and got["c"]["n"] == len(p)
    assert got["same"]["silhouette"] == 0.0


def test_rand_index(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 6 + [(1, 2)]
    df = spark.createDataFrame(rows, "a int, b int")
    swapped = df.withColumn("b", F.when(F.col("b") == 0, 9).otherwise(F.col("b") * -3))
    v = clustering.adjusted_rand(df, "a", "b").first()["ari"]
    pairs = [(rows[i], rows[j]) for i in range(len(rows)) for j in range(i)]
    same = np.array([[x[0] == y[0], x[1] == y[1]] for x, y in pairs])
    n, sa, sb, sab = len(pairs), same[:, 0].sum(), same[:, 1].sum(), same.all(axis=1).sum()
    assert v == pytest.approx((sab - sa * sb / n) / ((sa + sb) / 2 - sa * sb / n))
    assert clustering.adjusted_rand(swapped, "a", "b").first()["ari"] == pytest.approx(v)
    assert clustering.adjusted_rand(df.withColumn("b", F.col("a")), "a", "b").first()["ari"] == 1.0


def test_pca(spark):
    x = np.random.default_rng(0).normal(size=(300, 3)) @ np.array([[3.0, 1, 0], [0, 1, 0.5], [0, 0, 0.2]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    model = clustering.pca_fit(df, ["a", "b", "c"])
    values = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) ** 2
    assert model["explained"] == pytest.approx(values[:2] / values.sum())
    out = clustering.pca_project(df, model).toPandas()
    assert out[["pc1", "pc2"]].mean().abs().max() < 1e-9
    assert out.pc1.var(ddof=0) == pytest.approx(values[0] / 300)


def test_smote_points_lie_between_neighbours(spark, points):
    df, p = points
    rows = df.withColumn("y", (F.col("vec")[0] > 2.2).cast("int")).select(
        "id", "y", *[F.col("vec")[i].alias(c) for i, c in enumerate("abc")])
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    out = augment.smote(rows, "id", ["a", "b", "c"], "y", 0.8, 3)
    made = out.collect()
    assert len(made) == int(sizes[0] * 0.8) - sizes[1] > 0
    for r in made:
        a, b = p[r["base"]], p[r["neighbor"]]
        assert r["base"] != r["neighbor"] and r["y"] == 1 and 0 <= r["lam"] < 1
        assert [r["a"], r["b"], r["c"]] == pytest.approx(list(a + r["lam"] * (b - a)))
    assert {tuple(r) for r in made} == {tuple(r) for r in augment.smote(rows.repartition(3), "id", ["a", "b", "c"], "y", 0.8, 3).collect()}
    assert augment.smote(rows, "id", ["a", "b", "c"], "y", 0.1, 3).count() == 0


def test_assignments_to_several_sets_of_centres(spark):
    rng = np.random.default_rng(4)
    p = rng.integers(-3, 4, (500, 24)) / 2 + rng.normal(size=(500, 24)) * (np.arange(500) % 2)[:, None]
    cols = [f"x{i}" for i in range(24)]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(p)], ["id", *cols])
    sets = {f"k{k}": rng.integers(-2, 3, (k, 24)) / 2 for k in range(2, 11)}
    out = clustering.kmeans_assign_all(df, cols, sets)
    for name, centres in sets.items():
        want = clustering.kmeans_assign(df, cols, centres).select("id", "cluster", "dist2")
        assert sorted(map(tuple, out.select("id", name, f"cost{name}").collect())) == sorted(map(tuple, want.collect()))
    plan = out.agg(*[F.sum(f"cost{k}") for k in sets])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" - ") < 100  # not a term per column and centre
