"""Exact neighbour search over dense vectors as Spark joins on metric cells.

Points are assigned to the nearest of a bounded set of pivots, and a cell that holds too many is split again by pivots of
its own, level by level, so that cells stay small at any number of points. The triangle inequality then tells, for a query
and a search radius, which cells can hold an answer, so a query is only sent there. A cell of any size is cut into chunks:
one task compares one chunk of queries with one chunk of candidates and returns per-query results (k best, a sum, a label),
never the pairs.

Equal vectors are collapsed to one weighted point first, so a group of copies of any size costs
as much as a single point.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wavelattice.functions.scalars import keyed_digest
from wavelattice.operators.skew import apply_with_facts, join_facts, result_schema
from wavelattice.session import fresh_cut

CHUNK = 2000          # points on either side of a small comparison block
WIDEST = 8            # a side of a large one, in chunks: rows are copied once for every block they take part in
BLOCKS = 256          # blocks that a comparison is cut into before they get larger than a chunk
TILE = 512            # queries whose distances to a block of candidates are in memory at a time
CELL_TARGET = 16000   # aimed-at points per cell; a cell of over twice as many is split
MAX_PIVOTS = 4096     # pivots of the first level: all that is broadcast
FAN = 64              # pivots of a cell that is split, a power of two
MAX_DEPTH = 8         # levels below the first; 4096 * 64 ** 8 cells


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared Euclidean distances between two blocks, one dimension at a time."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        diff = a[:, i, None] - b[None, :, i]
        out += diff * diff
    return out


def pair_distances(a: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """The entries ``row, col`` of :func:`squared_distances`, to the last bit."""
    out = np.zeros(len(row))
    for i in range(a.shape[1]):
        diff = a[row, i] - b[col, i]
        out += diff * diff
    return out


def _products(a: np.ndarray, b: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float] | None:
    """``x, y, slack, norms, unit``: ``unit * (x @ y)`` are the squared distances of two blocks up to ``unit * slack`` per row.

    Both blocks are moved by one vector and divided by one power of two, so the error is small beside their spread wherever
    they lie. ``norms`` is the largest squared norm of a row of ``a`` and of ``b`` together. None if that has no finite numbers.
    """
    with np.errstate(all="ignore"):
        middle = b.mean(axis=0)
        a, b = a - middle, b - middle
        top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
        if not 1e-100 < top < 1e100:  # also if it is NaN
            return None
    scale = 2.0 ** math.ceil(math.log2(top))
    a, b = (a / scale).astype(kind), (b / scale).astype(kind)
    a2, b2 = ((v.astype(float) ** 2).sum(axis=1) for v in (a, b))
    x = np.column_stack([-2 * a, a2.astype(kind), np.ones(len(a), kind)])
    y = np.column_stack([b, np.ones(len(b), kind), b2.astype(kind)])
    # rounded coordinates and norms, and the sum of as many products: a multiple of the unit round-off of the norms
    slack = 2 * (a.shape[1] + 16) * (np.finfo(kind).eps * (a2 + b2.max()) + np.finfo(kind).tiny)
    return x, np.ascontiguousarray(y.T), slack, float(a2.max() + b2.max()), scale * scale


def _tiles(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, float]]:
    """``rows, d, slack, unit`` per tile: squared distances over ``unit``, each right up to the row's ``slack``."""
    made = _products(a, b, np.float32) if len(a) and len(b) else None
    for lo in range(0, len(a), TILE):
        rows = slice(lo, min(lo + TILE, len(a)))
        if made is None:
            d = squared_distances(a[rows], b)
            yield rows, d, np.zeros(len(d)), 1.0
        else:
            x, y, slack, _, unit = made
            yield rows, x[rows] @ y, slack[rows], unit


def _at_most(limit: np.ndarray, d: np.ndarray, toward: float = np.inf) -> np.ndarray:
    """``limit`` as a column of the precision of ``d``, rounded ``toward``."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nextafter(limit.astype(d.dtype), d.dtype.type(toward))[:, None]


def _exact(a: np.ndarray, b: np.ndarray, rows: slice, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    if 8 * len(row) > (rows.stop - rows.start) * len(b):
        return squared_distances(a[rows], b)[row, col]
    return pair_distances(a[rows], b, row, col)


def nearest_pairs(a: np.ndarray, b: np.ndarray, m: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, col, squared distance`` of the pairs that may be among the ``m`` nearest of a row of ``a``, if within its ``limit``.

    A matrix product rules out the others by its error bound; what is left is measured as :func:`squared_distances` does.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for rows, d, slack, unit in _tiles(a, b):
        cut = limit[rows] / unit + slack
        hit = d <= _at_most(cut, d)
        if np.count_nonzero(hit) > 4 * m * len(d):
            k = min(m, d.shape[1]) - 1
            kth = np.partition(d, k, axis=1)[:, k].astype(float)
            hit = d <= _at_most(np.minimum(cut, kth + 2 * slack), d)
        row, col = np.nonzero(hit)
        found.append((row + rows.start, col, _exact(a, b, rows, row, col)))
    return tuple(map(np.concatenate, zip(*found)))


def within(a: np.ndarray, b: np.ndarray, limit: float) -> Iterator[tuple[slice, np.ndarray]]:
    """``rows, near`` per tile: whether the squared distances are at most ``limit``; pairs in doubt are measured exactly."""
    for rows, d, slack, unit in _tiles(a, b):
        near = d <= _at_most(limit / unit - slack, d, -np.inf)
        row, col = np.nonzero((d <= _at_most(limit / unit + slack, d)) ^ near)
        near[row, col] = _exact(a, b, rows, row, col) <= limit
        yield rows, near


#: Squared distance, as a share of the largest norms, from which on the product's distance is right to eleven digits.
CLOSE = 1e-6


def distances(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """``rows, d`` per tile: Euclidean distances by a matrix product, those of close pairs from their differences."""
    made = _products(a, b, np.float64) if len(a) and len(b) else None
    for lo in range(0, len(a), TILE):
        rows = slice(lo, min(lo + TILE, len(a)))
        if made is None:
            yield rows, np.sqrt(squared_distances(a[rows], b))
            continue
        x, y, _, norms, unit = made
        d = x[rows] @ y
        row, col = np.nonzero(d <= CLOSE * norms)
        d[row, col] = _exact(a, b, rows, row, col) / unit
        np.sqrt(d, out=d)
        d *= math.sqrt(unit)
        yield rows, d


def matrix(table: pa.Table, column: str = "vec") -> np.ndarray:
    """A column of equally long lists as rows of a matrix."""
    flat = table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1 if table.num_rows else 0)


def numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


def collapse_copies(df: DataFrame, key: str, vec: str, keep: int = 1) -> DataFrame:
    """Distinct vectors as ``pt`` (smallest key), ``vec``, ``weight`` and the ``keep`` smallest keys.

    The row limit per vector is applied inside every partition before the shuffle.
    """
    rows = df.select(F.col(key).alias("_id"), F.col(vec).cast("array<double>").alias("vec"))
    weights = rows.groupBy("vec").agg(F.count("*").alias("weight"), F.min("_id").alias("pt"))
    if keep == 1:
        return weights.select("pt", "vec", "weight", F.array("pt").alias("members"))
    first = Window.partitionBy("vec").orderBy("_id")
    small = rows.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= keep)
    members = small.groupBy("vec").agg(F.sort_array(F.collect_list("_id")).alias("members"))
    return weights.join(members, "vec").select("pt", "vec", "weight", "members")


@dataclass
class Cells:
    """Placed points, the bounded facts of the first level, and a table of children per level below it.

    A cell's number tells its level: ``MAX_PIVOTS + i`` on the first, ``parent * FAN + i`` below.
    """

    points: DataFrame   # pt, ..., top, cell (the leaf), own (distance to the leaf's pivot)
    pivots: np.ndarray
    radius: np.ndarray
    reach: np.ndarray   # per cell: pivot distance of its m-th nearest point (inf if it has fewer)
    size: np.ndarray
    split: np.ndarray   # whether a cell of the first level has children
    levels: list[DataFrame] = field(default_factory=list)  # cell and flat facts of its children


def _nearest(v: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place, own = np.zeros(len(v), np.int64), np.zeros(len(v))
    for at in range(0, len(v), CHUNK):
        d2 = squared_distances(v[at:at + CHUNK], pivots)
        best = d2.argmin(axis=1)
        place[at:at + CHUNK] = best
        own[at:at + CHUNK] = np.sqrt(d2[np.arange(len(best)), best])
    return place, own


def _facts(placed: DataFrame, m: int) -> DataFrame:
    """``cell, radius, size, reach`` of every cell."""
    nearest = Window.partitionBy("cell").orderBy("own", "pt")
    close = placed.select("cell", "own", "pt").withColumn("_r", F.row_number().over(nearest)).filter(F.col("_r") <= m)
    reach = close.groupBy("cell").agg(F.when(F.count("*") >= m, F.max("own")).otherwise(F.lit(float("inf"))).alias("reach"))
    return placed.groupBy("cell").agg(F.max("own").alias("radius"), F.count("*").alias("size")).join(reach, "cell")


def _split_once(placed: DataFrame, m: int) -> tuple[DataFrame, DataFrame] | None:
    """Points placed anew in the children of all cells that are too large, and the facts of those children."""
    sizes = fresh_cut(placed.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * CELL_TARGET))
    if sizes.isEmpty():
        return None
    large = sizes.select("cell", F.least(F.ceil(F.col("n") / CELL_TARGET), F.lit(FAN)).alias("_fan"), "n")
    inside = join_facts(placed, large, "cell", "n", "pt")
    by_digest = Window.partitionBy("cell").orderBy(keyed_digest(F.col("pt"), "split"), "pt")
    pivots = inside.select("cell", "vec", "_fan", "pt").withColumn("_r", F.row_number().over(by_digest))
    pivots = pivots.filter((F.col("_r") <= FAN) & (F.col("_r") <= F.col("_fan")))
    pivots = fresh_cut(pivots.select("cell", "vec", (F.col("_r") - 1).alias("i")))
    packed = pivots.groupBy("cell").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("i", "vec"))), lambda x: x["vec"])).alias("pivots"))  # at most FAN vectors

    def place(rows: pa.Table, fact: pa.Table) -> pa.Table:
        v = matrix(rows)
        where, own = _nearest(v, matrix(fact, "pivots").reshape(-1, v.shape[1]))
        return pa.table({"_pt": rows.column("pt"), "_cell": numbers(rows, "cell") * FAN + where, "_own": own})

    moved = apply_with_facts(inside.select("pt", "vec", "cell"), packed, "cell", "pt", place, "_pt long, _cell long, _own double", 4 * CHUNK)
    again = fresh_cut(placed.join(moved, F.col("pt") == F.col("_pt"), "left").select(
        *[c for c in placed.columns if c not in ("cell", "own")], F.coalesce("_cell", "cell").alias("cell"), F.coalesce("_own", "own").alias("own")))
    facts = _facts(again.join(sizes.select(F.col("cell").alias("_parent")), F.expr(f"cell div {FAN}") == F.col("_parent"), "left_semi"), m)
    children = facts.join(pivots.select((F.col("cell") * FAN + F.col("i")).alias("cell"), "vec"), "cell")
    child = F.struct("cell", "radius", "size", "reach", "vec")
    table = children.groupBy(F.expr(f"cell div {FAN}").alias("parent")).agg(F.sort_array(F.collect_list(child)).alias("c"))  # at most FAN
    return again, fresh_cut(table.select(
        F.col("parent").alias("cell"), *[F.col(f"c.{x}").alias(f"{x}s") for x in ("cell", "radius", "size", "reach")],
        F.flatten("c.vec").alias("pivots")))


def build_cells(points: DataFrame, m: int = 1) -> Cells:
    """Choose pivots, place every point in its nearest pivot's cell, measure the cells and split those that are too large."""
    points = fresh_cut(points)
    n = points.count()
    wanted = max(1, min(MAX_PIVOTS, -(-n // CELL_TARGET)))
    chosen = points.orderBy(keyed_digest(F.col("pt"), "pivot")).limit(wanted).select("vec").collect()
    pivots = np.array([r["vec"] for r in chosen], float).reshape(len(chosen), -1 if chosen else 0)

    @F.arrow_udf("struct<cell:bigint,own:double>")
    def place(vec: pa.Array) -> pa.Array:
        v = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), pivots.shape[1])
        cell, own = _nearest(v, pivots)
        return pa.StructArray.from_arrays([pa.array(cell), pa.array(own)], ["cell", "own"])

    where = place("vec") if n else F.struct(F.lit(0).cast("bigint").alias("cell"), F.lit(0.0).alias("own"))
    placed = fresh_cut(points.withColumn("_p", where).select(
        *points.columns, F.col("_p.cell").alias("top"), (F.col("_p.cell") + MAX_PIVOTS).alias("cell"), "_p.own"))
    radius, reach = np.zeros(len(pivots)), np.full(len(pivots), np.inf)
    size = np.zeros(len(pivots), np.int64)
    for f in _facts(placed, m).collect():  # <= MAX_PIVOTS rows
        i = f["cell"] - MAX_PIVOTS
        radius[i], size[i], reach[i] = f["radius"], f["size"], f["reach"]
    levels, split = [], size > 2 * CELL_TARGET
    while len(levels) < MAX_DEPTH and (more := _split_once(placed, m)) is not None:
        placed, children = more
        levels.append(children)
    return Cells(placed, pivots, radius, reach, size, split & bool(levels), levels)


def _reachable(d: np.ndarray, own: np.ndarray, radius: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Which cells, by pivot distances ``d``, may hold a point within ``theta``; ``own`` is the least of a row's distances."""
    bound = np.maximum(d - radius, (d - own[:, None]) / 2.0)  # beyond the ball, or beyond the plane between two pivots
    return bound <= theta[:, None] + 1e-9 * (1.0 + d)


def visits(queries: DataFrame, cells: Cells, radius: str) -> DataFrame:
    """Explode every query to the leaf cells (``to_cell``) but its own that may hold a point within its radius.

    The radius is first lowered to what the cell facts alone guarantee to contain enough points.
    """
    pivots, rad, reach, size, split = cells.pivots, cells.radius, cells.reach, cells.size, cells.split

    @F.arrow_udf("array<bigint>")
    def targets(vec: pa.Array, top: pa.Array, bound: pa.Array) -> pa.Array:
        v = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), pivots.shape[1])
        home = top.to_numpy(zero_copy_only=False)
        limit = bound.to_numpy(zero_copy_only=False)
        counts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(v), CHUNK):
            h = home[at:at + CHUNK]
            d = np.sqrt(squared_distances(v[at:at + CHUNK], pivots))
            theta = np.minimum(limit[at:at + CHUNK], (d + reach).min(axis=1))
            hit = _reachable(d, d.min(axis=1), rad, theta) & (size > 0)
            hit[np.arange(len(h)), h] = split[h]
            row, col = np.nonzero(hit)
            counts.append(np.bincount(row, minlength=len(h)))
            found.append(col + MAX_PIVOTS)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))

    out = queries.withColumn("to_cell", F.explode(targets("vec", "top", radius)))

    def descend(rows: pa.Table, fact: pa.Table) -> pa.Table:
        v, limit, home = matrix(rows), numbers(rows, "_bound"), numbers(rows, "_home")
        ids, rads, reaches = (fact.column(c)[0].values.to_numpy() for c in ("cells", "radiuss", "reachs"))
        centres = matrix(fact, "pivots").reshape(len(ids), -1)
        d = np.sqrt(squared_distances(v, centres))
        theta = np.minimum(limit, (d + reaches).min(axis=1))
        hit = _reachable(d, d.min(axis=1), rads, theta) & (home[:, None] != ids)
        row, col = np.nonzero(hit)
        return pa.table({"_pt": numbers(rows, "pt")[row], "to_cell": ids[col]})

    for children in cells.levels:
        # (query, split cell) pairs become (query, child) pairs; the other columns come back by the query's key
        narrow = out.select("pt", "vec", F.col("cell").alias("_home"), F.col(radius).cast("double").alias("_bound"), "to_cell")
        facts = children.withColumnRenamed("cell", "to_cell")
        lower = apply_with_facts(narrow, facts, "to_cell", "pt", descend, "_pt long, to_cell long", CHUNK)
        lower = queries.join(lower, F.col("pt") == F.col("_pt")).drop("_pt")
        out = fresh_cut(out.join(children.select(F.col("cell").alias("to_cell")), "to_cell", "left_anti")
                          .select(*queries.columns, "to_cell").unionByName(lower))
    return out


def block_side(pairs: float) -> int:
    """Points on either side of a block: enough blocks for all cores, then as few copies of a row as a task's memory allows."""
    return int(min(max(CHUNK, math.sqrt(pairs / BLOCKS)), WIDEST * CHUNK))


def _chunks(n_column, side: int) -> "F.Column":
    return F.greatest(F.ceil(n_column / side), F.lit(1)).cast("int")


def compare_blocks(queries: DataFrame, candidates: DataFrame, func, result: str) -> DataFrame:
    """Run ``func(queries, candidates)`` (Arrow tables) on chunks that share a cell.

    ``queries`` come with ``to_cell``, ``candidates`` with ``cell``. Both are salted by their key
    hash into chunks of ``CHUNK`` rows or, in large comparisons, up to ``WIDEST`` times as many, so a cell with a third of
    all rows becomes many small groups. Cells that are one chunk are dealt in bundles of about as many rows.
    """
    q_size = queries.groupBy(F.col("to_cell").alias("cell")).agg(F.count("*").alias("_q"))
    c_size = candidates.groupBy("cell").agg(F.count("*").alias("_c"))
    sizes = fresh_cut(q_size.join(c_size, "cell").select("cell", "_q", "_c"))
    side = block_side(sizes.agg(F.coalesce(F.sum(F.col("_q").cast("double") * F.col("_c")), F.lit(0.0))).first()[0])  # one row
    sizes = sizes.withColumns({"nq": _chunks(F.col("_q"), side), "nc": _chunks(F.col("_c"), side)})
    small = (F.col("nq") == 1) & (F.col("nc") == 1)
    total = sizes.filter(small).agg(F.coalesce(F.sum(F.col("_q") + F.col("_c")), F.lit(0))).first()[0]  # one row
    bundles = max(1, -(-total // side))
    sizes = sizes.withColumn("_small", small).withColumn(
        "_at", F.when(small, F.pmod(F.xxhash64("cell"), F.lit(bundles))).otherwise(F.col("cell")))
    q = queries.drop("cell").withColumnRenamed("to_cell", "cell")
    q = (join_facts(q, sizes.drop("_c"), "cell", "_q", "pt")
         .withColumn("qs", F.pmod(F.xxhash64("pt"), F.col("nq")).cast("int"))
         .withColumn("cs", F.explode(F.sequence(F.lit(0), F.col("nc") - 1)))
         .drop("nq", "nc"))
    c = (join_facts(candidates, sizes.drop("_q"), "cell", "_c", "pt")
         .withColumn("cs", F.pmod(F.xxhash64("pt"), F.col("nc")).cast("int"))
         .withColumn("qs", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)))
         .drop("nq", "nc"))
    c = c.select(*[F.col(x).alias(x) for x in c.columns])  # both sides may stem from one table
    keys = ["_small", "_at", "qs", "cs"]
    empty = result_schema(result).empty_table()

    def runs(table: pa.Table) -> tuple[pa.Table, dict]:
        table = table.sort_by("cell").combine_chunks()
        found, begin, size = np.unique(numbers(table, "cell"), return_index=True, return_counts=True)
        return table, {c: (b, n) for c, b, n in zip(found.tolist(), begin.tolist(), size.tolist())}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        left, asked = runs(left)
        right, held = runs(right)
        parts = [func(left.slice(*asked[c]), right.slice(*held[c])) for c in asked if c in held]
        return pa.concat_tables(parts) if parts else empty

    return q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(run, result)


def nearest_in_cells(queries: DataFrame, candidates: DataFrame, m: int) -> DataFrame:
    """The ``m`` nearest candidates of every query in the cells it visits; with a column ``bound``, only those within it."""
    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        limit = np.full(left.num_rows, np.inf)
        if "bound" in left.column_names:
            limit = numbers(left, "bound") ** 2 * (1 + 1e-12)
        row, col, d2 = nearest_pairs(matrix(left), matrix(right), m, limit)
        ids = numbers(right, "pt")[col]
        order = np.lexsort((ids, d2, row))
        row, d2, ids = row[order], d2[order], ids[order]
        first = np.searchsorted(row, row)
        top = np.arange(len(row)) - first < m
        return pa.table({"pt": numbers(left, "pt")[row[top]], "near_pt": ids[top], "distance": np.sqrt(d2[top])})

    return compare_blocks(queries, candidates, block, "pt long, near_pt long, distance double")


def keep_best(found: DataFrame, m: int) -> DataFrame:
    order = Window.partitionBy("pt").orderBy("distance", "near_pt")
    return found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= m).drop("_r")


def rows_of_points(rows: DataFrame, points: DataFrame, both: DataFrame, key: str, k: int) -> DataFrame:
    """Neighbours of rows from neighbours of distinct points (``pt, near_pt, distance``, itself included)."""
    m = k + 1
    members = points.select(F.col("pt").alias("near_pt"), "members")
    near = (both.join(members, "near_pt")
            .select("pt", F.transform("members", lambda x: F.struct(F.col("distance").alias("distance"), x.alias("id"))).alias("c"))
            .groupBy("pt").agg(F.slice(F.sort_array(F.flatten(F.collect_list("c"))), 1, m).alias("near")))
    located = near.join(points.select("pt", "vec", "weight"), "pt").select("vec", "near", "weight")
    picked = join_facts(rows, located, "vec", "weight", key, narrow=False).select(
        key, F.slice(F.filter("near", lambda x: x["id"] != F.col(key)), 1, k).alias("near"))
    return picked.select(key, F.posexplode("near").alias("_pos", "n")).select(
        key, F.col("n.id").alias("neighbor"), (F.col("_pos") + 1).alias("rank"), F.col("n.distance").alias("distance"))


def vectors_of(df: DataFrame, key: str, vec: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias(key), F.col(vec).cast("array<double>").alias("vec"))


def knn(df: DataFrame, key: str, vec: str, k: int = 5) -> DataFrame:
    """Exact k nearest other rows as ``key, neighbor, rank, distance`` (ties: smaller key first).

    First every point is compared with its own cell; the distance of its k-th hit then limits which
    other cells it visits.
    """
    m = k + 1
    rows = vectors_of(df, key, vec)
    cells = build_cells(collapse_copies(rows, key, "vec", m), m)
    pts = cells.points.select("pt", "vec", "top", "cell")
    home = fresh_cut(keep_best(nearest_in_cells(pts.withColumn("to_cell", F.col("cell")), pts, m), m))
    bound = home.groupBy(F.col("pt").alias("_pt")).agg(
        F.when(F.count("*") >= m, F.max("distance")).otherwise(F.lit(float("inf"))).alias("bound"))
    away = visits(pts.join(bound, F.col("pt") == F.col("_pt")).drop("_pt"), cells, "bound")
    both = keep_best(home.unionByName(nearest_in_cells(away, pts, m)), m)
    return rows_of_points(rows, cells.points, both, key, k)


def eps_neighbor_counts(pts: DataFrame, visiting: DataFrame, eps: float) -> DataFrame:
    """``pt, n_near``: rows within ``eps`` of every distinct point, itself included.

    ``pts`` are weighted points in their cells, ``visiting`` the points with a ``to_cell`` for every cell near them.
    """
    limit = eps * eps

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        weight = numbers(right, "weight")
        single = bool((weight == 1).all())
        counts = [np.count_nonzero(near, axis=1) if single else (near.astype(float) @ weight.astype(float)).astype(np.int64)
                  for _, near in within(matrix(left), matrix(right), limit)]
        return pa.table({"pt": left.column("pt"), "n_near": np.concatenate(counts)})

    found = compare_blocks(visiting, pts.select("pt", "vec", "weight", "cell"), block, "pt long, n_near long")
    return found.groupBy("pt").agg(F.sum("n_near").alias("n_near"))
