"""Exact nearest neighbours by a block matrix join.

Candidates and queries are dealt into blocks; each pair of a query block and a
candidate block is one task's work. There, products of int8 codes give every
cosine within a bound that follows from the codes' own errors. What could be
among a query's nearest within these bounds is computed again from the given
vectors, and heaps merge the tiles' and the blocks' best.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a candidate block, a query block, and a tile of the product.
BLOCK, QUERY_BLOCK, TILE = 8_192, 4_096, 2_048

RESULT = "query_id long, vec_id long, score double"


def _vectors(table: pa.Table) -> np.ndarray:
    flat = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(table.num_rows, -1)


def running_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row products, summed from the first component to the last."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


class Codes:
    """Unit vectors as int8 with one scale each, and the length of what the codes miss."""

    def __init__(self, x: np.ndarray):
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        self.scale = np.abs(unit).max(1) / 127
        self.int8 = np.rint(unit / self.scale[:, None]).astype(np.int8)
        back = self.int8 * self.scale[:, None]
        self.error, self.length = np.linalg.norm(unit - back, axis=1), np.linalg.norm(back, axis=1)

    def rows(self, s: slice) -> np.ndarray:
        # float32 holds the sums of int8 products exactly up to 1040 components, float64 far beyond
        return self.int8[s].astype(np.float32 if self.int8.shape[1] <= 1040 else np.float64)


def best(queries: tuple[np.ndarray, np.ndarray], block: tuple[np.ndarray, np.ndarray], k: int) -> list[tuple[int, int, float]]:
    """(query_id, vec_id, score) of the k nearest of each query in the block."""
    (qid, q), (cid, c) = queries, block
    qn, cn = np.sqrt(running_dot(q, q)), np.sqrt(running_dot(c, c))
    qc, cc = Codes(q), Codes(c)
    heaps: list[list[tuple[float, int]]] = [[] for _ in qid]
    for qs in range(0, len(qid), TILE):
        rows = slice(qs, qs + TILE)
        left = qc.rows(rows)
        for cs in range(0, len(cid), TILE):
            cols = slice(cs, cs + TILE)
            near = (left @ cc.rows(cols).T) * qc.scale[rows, None] * cc.scale[None, cols]
            slack = cc.error[None, cols] + qc.error[rows, None] * cc.length[None, cols] + 1e-9
            low = near - slack
            low[qid[rows, None] == cid[None, cols]] = -np.inf
            floor = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
            held = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[rows]])
            i, j = np.nonzero((near + slack >= np.maximum(floor, held)[:, None]) & (qid[rows, None] != cid[None, cols]))
            i, j = i + qs, j + cs
            for a in range(0, len(i), 1 << 16):
                x, y = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
                score = running_dot(q[x], c[y]) / (qn[x] * cn[y])
                for r, v, s in zip(x.tolist(), cid[y].tolist(), score.tolist(), strict=True):
                    h = heaps[r]
                    if len(h) < k:
                        heapq.heappush(h, (s, -v))
                    elif (s, -v) > h[0]:
                        heapq.heapreplace(h, (s, -v))
    return [(int(qid[r]), -v, s) for r, h in enumerate(heaps) for s, v in h]


def _result(rows: list[tuple]) -> pa.Table:
    a, b, c = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k largest cosines among all other rows.

    Ties go to the smaller vec_id. Rows whose id or vector is null, or whose
    vector is zero, empty or has null or non-finite components, take no part;
    vectors of different lengths are not compared; a vec_id is never its own
    neighbour, even if repeated. Fewer than k candidates are all returned, and
    an empty table gives none; other columns are ignored, whatever their names.
    Every block of queries meets every block of candidates, once: the work is
    the product of both numbers, as exact search needs. Of
    equal vectors only the k + 1 smallest ids can be among the nearest, so the
    rest leave before the join.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), is_query.alias("query")).where("embedding is not null").where(good)
    n, q = rows.agg(F.count("*"), F.sum(F.col("query").cast("long"))).first()
    blocks, query_blocks = max(1, math.ceil(n / block)), max(1, math.ceil((q or 0) / query_block))
    few = Window.partitionBy("embedding").orderBy("vec_id")
    others = rows.select("vec_id", "embedding").distinct().withColumn("n", F.row_number().over(few)).where(F.col("n") <= k + 1).drop("n")
    dealt = lambda df, n, name: df.withColumn(name, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
    spread = lambda df, n, name: df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    left = spread(dealt(rows.where("query").select("vec_id", "embedding").distinct(), query_blocks, "h"), blocks, "g")
    right = spread(dealt(others, blocks, "g"), query_blocks, "h").select("g", "h", F.col("vec_id").alias("near_id"), F.col("embedding").alias("near"))

    def tile(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and candidates.num_rows:
            candidates = candidates.select(["near_id", "near"]).rename_columns(["vec_id", "embedding"])
            size = lambda t: np.diff(t["embedding"].combine_chunks().offsets.to_numpy())
            qs, cs = size(queries), size(candidates)
            for d in np.intersect1d(qs, cs):
                a, b = (t.filter(pa.array(s == d)).sort_by("vec_id") for t, s in ((queries, qs), (candidates, cs)))
                found += best((a["vec_id"].to_numpy(), _vectors(a)), (b["vec_id"].to_numpy(), _vectors(b)), k)
        return _result(found)

    def merge(table: pa.Table) -> pa.Table:
        top = heapq.nsmallest(k, zip((-table["score"].to_numpy()).tolist(), table["vec_id"].to_pylist(), strict=True))
        return pa.table({"query_id": table["query_id"][: len(top)], "rank": pa.array(range(1, len(top) + 1), pa.int32()), "vec_id": pa.array([v for _, v in top], pa.int64()), "score": pa.array([-s for s, _ in top], pa.float64())})

    tiles = left.groupBy("g", "h").cogroup(right.groupBy("g", "h")).applyInArrow(tile, RESULT)
    return tiles.groupBy("query_id").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")
