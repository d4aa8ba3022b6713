"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Vectors become integer vectors. They are dealt to shards by a hash of the id; a shard keeps its vectors in one list per
dimension, sorted by the value. For a query the lists are read from the end that raises the score (the top where the
query is positive, the bottom where it is negative), a block of entries of every list at a time. Each vector met is scored
exactly. The sum over dimensions of the query times the last values read bounds every vector not met yet; once the kth
best score exceeds it, no other vector of the shard can enter, not even by a tie, and the shard is done. The k best of
every shard are merged by query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wavelattice.llm.common import settled, table

SHARD_ROWS = 8192
QUERY_ROWS = 512
FIRST_BLOCK = 8
_PAIR = "query_id bigint, _dim int, _copy int, vec_id bigint, score bigint"
#: Sums of products below this are exact in double precision, so the scores come from matrix products.
_EXACT = float(1 << 52)


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``_id, _v`` with ``floor(scale * x)`` as bigint; without null keys and unusable vectors."""
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    sound = F.col(vector).isNotNull() & ~F.exists(
        x, lambda e: F.coalesce(e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")), F.lit(True)))
    return df.where(F.col(key).isNotNull() & sound).select(
        F.col(key).cast("bigint").alias("_id"), F.transform(x, lambda e: F.floor(e * scale).cast("bigint")).alias("_v"))


def _packed(rows: DataFrame, group: list[str]) -> DataFrame:
    """One row per group with its ids and its vectors end to end as bytes of int64."""
    def pack(key, t):
        ids = t.column("_id").to_numpy()
        vec = t.column("_v").combine_chunks()
        vec = vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec
        flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        dim = int(key[0].as_py())
        flat = flat.reshape(len(ids), dim)
        if len(np.unique(ids)) < len(ids):  # rows that share an id come in the order of their vectors, in every attempt
            order = np.lexsort((*flat.T[::-1], ids))
        flat = flat[order]
        return pa.table({"_dim": [dim], "_g": [int(key[1].as_py())], "_ids": [ids[order].tobytes()], "_mat": [flat.tobytes()]},
                        schema=pa.schema([("_dim", pa.int32()), ("_g", pa.int32()), ("_ids", pa.binary()), ("_mat", pa.binary())]))
    return rows.groupBy(*group).applyInArrow(pack, "_dim int, _g int, _ids binary, _mat binary")


class _Shard:
    """The sorted lists of one shard."""

    def __init__(self, ids: np.ndarray, mat: np.ndarray):
        self.ids, self.mat = ids, mat
        self.up = np.ascontiguousarray(np.argsort(mat, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(mat.T, self.up, axis=1)
        self.reach = float(np.abs(mat).max(initial=0))
        self.floats = mat.astype(np.float64)

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.reach * float(np.abs(q).max(initial=0)) * max(1, len(q)) < _EXACT:
            return (self.floats[rows] @ q.astype(np.float64)).astype(np.int64)
        whole = (self.mat[rows].astype(object) * q.astype(object)).sum(axis=1)
        return np.array([int(x) for x in whole], np.int64)  # fails if a score is no bigint

    def best(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        active = np.flatnonzero(q)
        if len(active) == 0:  # all scores are 0: the smallest ids are the answer
            rows = np.flatnonzero(self.ids != own)[:k]
            return self.ids[rows], np.zeros(len(rows), np.int64)
        down = q[active] > 0
        seen = self.ids == own
        got, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, FIRST_BLOCK
        weight = [int(x) for x in q[active]]
        while at < n:
            to = min(n, at + step)
            met = np.concatenate([self.up[active[down], n - to:n - at].ravel(), self.up[active[~down], at:to].ravel()])
            fresh = np.zeros(n, bool)
            fresh[met] = True
            fresh &= ~seen
            rows = np.flatnonzero(fresh)
            if len(rows):
                seen[rows] = True
                got, score = np.concatenate([got, rows]), np.concatenate([score, self.scores(rows, q)])
                if len(got) > k:  # rows are in id order, so ties go to the smaller id
                    keep = np.lexsort((self.ids[got], -score))[:k]
                    got, score = got[keep], score[keep]
            at, step = to, step * 2
            if len(got) == k:
                last = np.where(down, self.sorted[active, n - to], self.sorted[active, to - 1])
                if int(score[-1]) > sum(w * int(v) for w, v in zip(weight, last)) or seen.all():
                    break
        return self.ids[got], score


def top_k(candidates: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
          scale: int = 64, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` candidates of every query with the largest inner product.

    Ties go to the smaller id; the query's own id is no candidate. Rows with a null key, a null vector or a null or
    non-finite component take no part; queries and candidates of different lengths do not meet. Rows that repeat a key
    count as rows: each query row has a list of its own. An empty table gives an empty result. Other columns are not read. Scores must fit a bigint.
    """
    c = settled(integer_vectors(candidates, key, vector, scale).withColumn("_dim", F.size("_v")))
    q = integer_vectors(queries, key, vector, scale).withColumn("_dim", F.size("_v"))
    shards = max(1, -(-c.count() // shard_rows))
    where = F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int")
    deal = _packed(c.withColumn("_g", where), ["_dim", "_g"])
    n_q = q.count()
    blocks = max(1, -(-n_q // QUERY_ROWS))
    asks = _packed(q.withColumn("_g", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(blocks)).cast("int")), ["_dim", "_g"])
    # every block of the stated query set visits every shard
    asks = asks.select("_dim", F.col("_ids").alias("_qids"), F.col("_mat").alias("_qmat"),
                       F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_g"))
    pairs = deal.join(asks, ["_dim", "_g"]).select("_dim", "_ids", "_mat", "_qids", "_qmat")

    def search(batches):
        last, shard = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                dim, ids, mat, qids, qmat = (batch.column(j)[i].as_py() for j in range(5))
                if last != (dim, ids):
                    rows = np.frombuffer(ids, np.int64)
                    last, shard = (dim, ids), _Shard(rows, np.frombuffer(mat, np.int64).reshape(len(rows), dim))
                qs = np.frombuffer(qids, np.int64)
                block = np.frombuffer(qmat, np.int64).reshape(len(qs), dim)
                out = [shard.best(block[j], int(qs[j]), k) for j in range(len(qs))]
                sizes = [len(x) for x, _ in out]
                copy = np.arange(len(qs)) - np.searchsorted(qs, qs)  # query rows that share an id are told apart
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(qs, sizes), pa.int64()), pa.array(np.full(sum(sizes), dim), pa.int32()),
                    pa.array(np.repeat(copy, sizes), pa.int32()),
                    pa.array(np.concatenate([x for x, _ in out]), pa.int64()),
                    pa.array(np.concatenate([y for _, y in out]), pa.int64())], names=["query_id", "_dim", "_copy", "vec_id", "score"])

    found = pairs.mapInArrow(search, _PAIR)
    order = Window.partitionBy("query_id", "_dim", "_copy").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def query(spark, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return top_k(e, e.where(F.col("vec_id") % 20 == 0))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
