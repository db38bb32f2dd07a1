"""Whitening of embeddings: principal components of their whole-number form, scaled to unit variance.

Every distinct vector counts once. Tasks centre their rows and reduce them by
QR, block by block, to a triangle as wide as the vectors; triangles meet in a
tree of a fixed fan-in. Of the last one the singular values and vectors are
found (module qd): the squares, over n, are the covariance's eigenvalues, so no
covariance is ever formed, and none of its rounding comes in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import durable, qd, textops

#: Vectors with an entry of this size or more take no part, as sums of such entries could leave 64 bits.
LARGEST = 2.0**40

#: Rows of one QR step, and triangles that meet in one.
BLOCK, FAN_IN = 4_096, 64

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Model:
    """n distinct vectors, their sums, one scaled direction for each component, and each one's share of the variance."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact while it fits 64 bits."""
        return self.n * (x - self.sums // self.n) - self.sums % self.n

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums // self.n) - (self.sums % self.n) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def whole_numbers(embedding: Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """floor(scale * c) + offset of each entry c as a double."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(vec_id, x) of each row that takes part.

    Rows whose vector is null or empty, or holds an entry that is null, not
    finite or as large as LARGEST, are left out, and so are those of another
    length than most (of equally common lengths, the greatest).
    """
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("e")).where("e is not null").where((F.size("e") > 0) & ~F.exists("e", bad))
    most = rows.groupBy(F.size("e").alias("d")).agg(F.count("*").alias("k")).agg(F.max(F.struct("k", "d")).alias("m")).first()["m"]
    return rows.where(F.size("e") == (most["d"] if most else 0)).select("vec_id", whole_numbers(F.col("e"), scale, offset).alias("x"))


def _sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            x = _matrix(b.column(0))
            n, total = n + len(x), x.sum(0) if total is None else total + x.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total), pa.array(np.full(len(total), n))], names=["p", "s", "n"])

    each = fit.mapInArrow(add, "p int, s long, n long").groupBy("p").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("p").collect()  # one row a dimension
    return (each[0]["n"] if each else 0), np.array([r["s"] for r in each], np.int64)


def _stacked(triangle: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """The triangle of all rows so far."""
    return np.linalg.qr(rows if triangle is None else np.vstack([triangle, rows]), mode="r")


def _triangle(fit: DataFrame, model: Model) -> np.ndarray:
    """R of the centred rows."""
    d = len(model.sums)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, part = None, 0
        for b in batches:
            x = _matrix(b.column(0))
            part = b.column(1)[0].as_py() if len(x) else part
            for i in range(0, len(x), BLOCK):
                r = _stacked(r, model.centred(x[i : i + BLOCK]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([r.tobytes()], pa.binary())], names=["part", "r"])

    def meet(table: pa.Table) -> pa.Table:
        r = None
        for row in table.sort_by("part")["r"]:
            r = _stacked(r, np.frombuffer(row.as_py()).reshape(-1, d))
        return pa.table({"part": pa.array([table["part"][0].as_py() // FAN_IN], pa.int32()), "r": pa.array([r.tobytes()], pa.binary())})

    parts = fit.rdd.getNumPartitions()
    rows = fit.withColumn("part", F.spark_partition_id()).mapInArrow(reduce, "part int, r binary")
    while True:
        rows = rows.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(meet, "part int, r binary")
        if parts <= FAN_IN:
            break
        parts = -(-parts // FAN_IN)
    r = np.frombuffer(rows.first()["r"]).reshape(-1, d)
    return np.vstack([r, np.zeros((max(0, d - len(r)), d))])  # fewer rows than dimensions


def fit(vectors: DataFrame, components: int = 16) -> tuple[Model, DataFrame]:
    """A model of the distinct vectors x, and these, written once.

    There are as many components as asked for, but no more than have any
    variance beyond rounding: directions in which all vectors agree can't be
    scaled to unit variance. identity_error is the largest difference between
    the whitened vectors' own covariance and the identity.
    """
    distinct = durable.rewritten(vectors.select("x").distinct(), "vectors")
    n, sums = _sums(distinct)
    d = len(sums)
    model = Model(n, sums, np.zeros((d, 0)), np.zeros(0))
    if not n:
        return model, distinct
    a, b, v = qd.bidiagonal(_triangle(distinct, model))
    found = qd.squares(a, b)
    sizes = np.sqrt(found)
    rank = int(np.sum(sizes > max(n, d) * qd.EPS * sizes[0])) if sizes[0] else 0
    k = min(components, rank)
    if not k:
        return model, distinct
    vectors_k = v @ qd.right_vectors(a, b, found, k)
    vectors_k *= np.where(vectors_k[np.argmax(np.abs(vectors_k), 0), range(k)] < 0, -1, 1)
    model.directions, model.explained = vectors_k * (np.sqrt(n) / sizes[:k]), found[:k] / found.sum()

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = model.whitened(_matrix(batch.column(0)))
            total += np.vstack([w.T @ w, w.sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["p", "v"])

    each = distinct.mapInArrow(products, "p int, v double").groupBy("p").agg(F.sum("v").alias("v")).orderBy("p").collect()  # (k + 1) * k rows
    total = np.array([row["v"] for row in each]).reshape(k + 1, k) / n
    covariance = total[:k] - np.outer(total[k], total[k])  # their means are zero but for rounding
    model.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return model, distinct


def whiten(vectors: DataFrame, components: int = 16, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """A row for each vector that takes part (see usable) and each component, by falling variance.

    n is the number of distinct vectors, deviation the exact sum of
    (n * x - sums)**2, or null where that doesn't fit 64 bits; whitened is the
    vector's place along the component, explained the component's share of all
    variance. Rows of null, repeated or clashing ids give rows of their own; no
    vectors, or vectors that are all alike, give none. Other columns are
    ignored, whatever their names.
    """
    rows = usable(vectors, vec_id, embedding)
    model, _ = fit(rows, components)
    k = len(model.explained)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in textops.slices(whole):
                if not k or not b.num_rows:
                    continue
                x = _matrix(b.column(1))
                ids = b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
                off = model.differences(x)
                sizes = (model.centred(x) * model.n) ** 2
                deviation = pa.array((off * off).sum(1), mask=sizes.sum(1) > 9.2e18)
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), deviation.take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(model.whitened(x).ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(place, RESULT)
