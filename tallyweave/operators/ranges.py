"""Rows in range partitions, and values carried from each partition into the later ones.

A key such as a chromosome may hold any share of the rows, so an ordered scan
over it isn't left to one task. Rows are dealt by range of key and order, each
range is scanned by itself, and what must go on across a border, a running
maximum or sum, is one small row for each range and key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyweave import folders


def dealt(rows: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows with the number _p of their range partition, written once, so that all uses see the same ranges."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return folders.rewritten(rows.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "ranges")


#: Rows that a task scans at a time.
BLOCK = 1 << 18


def scanned(rows: DataFrame, on: Sequence[str], order: Sequence[str], work: Callable[[pa.Table, np.ndarray], pa.Table], schema: str, parts: int | None = None) -> DataFrame:
    """What a function makes of rows in order, block by block, with the block's number _p, written once.

    Rows are dealt by range of key and order and sorted; in the same stage each
    task hands its blocks of BLOCK rows to work, with the number of each row's
    key inside the block. Blocks are numbered in the rows' order, so carried()
    joins what goes on over their borders as it does for ranges. schema is that
    of work's result.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = list(on)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[pa.RecordBatch] = []
        number = TaskContext.get().partitionId() << 32

        def made() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            new = np.zeros(table.num_rows, bool)
            for k in names:
                code = table[k].combine_chunks().dictionary_encode("encode").indices.to_numpy()
                new[1:] |= code[1:] != code[:-1]
            out = work(table, np.cumsum(new))
            yield from out.append_column("_p", pa.array(np.full(out.num_rows, number))).to_batches()

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= BLOCK:
                yield from made()
                held.clear()
                number += 1
        if sum(x.num_rows for x in held):
            yield from made()

    return folders.rewritten(rows.repartitionByRange(parts, *on, *order).sortWithinPartitions(*on, *order).mapInArrow(blocks, f"{schema}, _p long"), "blocks")


def fields(rows: DataFrame, names: Sequence[str]) -> str:
    """The named columns with their types, as a schema."""
    types = dict(rows.dtypes)
    return "".join(f"`{n}` {types[n]}, " for n in names)


def inside(on: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """A key's rows of one range, in order."""
    return Window.partitionBy("_p", *on).orderBy(*order)


def carried(rows: DataFrame, on: Sequence[str], back: bool = False, **values: tuple[Column, str]) -> DataFrame:
    """Rows with, for each name, a key's value over all earlier ranges (all later ones if back).

    A value is a pair of an aggregate over a range and how ranges are joined:
    "max", "min" or "sum". Without such ranges it is null. A null key is a key
    like others.
    """
    each = rows.groupBy("_p", *on).agg(*(c.alias(name) for name, (c, _) in values.items()))
    ends = (1, Window.unboundedFollowing) if back else (Window.unboundedPreceding, -1)
    over = Window.partitionBy(*(on or [F.lit(0)])).orderBy("_p").rowsBetween(*ends)  # at most one row for each range and key
    keys = ["_p", *on]
    sums = each.select(*(F.col(k).alias(f"_of_{k}") for k in keys), *(getattr(F, how)(name).over(over).alias(name) for name, (_, how) in values.items()))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys))
    return rows.join(sums, same).drop(*(f"_of_{k}" for k in keys))


def numbered(rows: DataFrame, order: Sequence[str], name: str = "row_id", start: int = 0, parts: int | None = None) -> DataFrame:
    """Dense global numbers in the given order, without a window over one partition.

    Rows are range-partitioned, sorted, and written with their place inside the
    partition; the sizes of the partitions before lift it. So there is one
    exchange, and what is read again after a lost executor is the same. Columns
    should make the order total; rows alike in all of them are told apart as
    they come.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = folders.rewritten(sorted_rows.withColumn("_m", F.monotonically_increasing_id()), "numbered")  # partition above 33 bits, place below
    part = F.shiftright("_m", 33)
    sizes = placed.groupBy(part.alias("_q")).agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_q", before.alias("_before"))  # one row for each partition
    out = placed.withColumn("_q", part).join(F.broadcast(sizes), "_q")
    return out.withColumn(name, (F.col("_m").bitwiseAND((1 << 33) - 1) + F.col("_before") + start).cast("long")).drop("_q", "_m", "_before")
