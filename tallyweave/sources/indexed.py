"""Interval tables in coordinate order with an index of their blocks, and reads that open only what regions can need."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyweave.operators import intervals

#: Rows of a block, and ranges of starts up to which they are told to the scan one by one.
BLOCK_ROWS, RANGES = 65_536, 500


def write(df: DataFrame, path: str, on: Sequence[str] = ("chrom",), parts: int | None = None, block_rows: int = BLOCK_ROWS) -> None:
    """Half-open intervals as Parquet sorted by key, start and end, and an index beside it.

    The index has a row for each file, block of rows in it, and key: the first
    and last start, the greatest end, how many rows, and reach, the greatest end
    of all blocks of the key so far, this one included. It is made from the
    written rows, of which only the key and both ends are read.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*on, "start", "end"]
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows").select(*order, F.col("_metadata.file_name").alias("file"), (F.col("_metadata.row_index") / block_rows).cast("long").alias("block"))
    blocks = rows.groupBy("file", "block", *on).agg(F.min("start").alias("first"), F.max("start").alias("last"), F.max("end").alias("most"), F.count("*").alias("n"))
    far = Window.partitionBy(*on).orderBy("first", "last", "file", "block")  # one row for each block_rows rows
    blocks.withColumn("reach", F.max("most").over(far)).write.parquet(f"{path}/index")


def index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def needed(blocks: DataFrame, regions: DataFrame, on: Sequence[str] = ("chrom",), bin_size: int = 1 << 20) -> DataFrame:
    """The index's blocks that a region may find rows in: those that begin before its end, and some row of which ends after its start."""
    spans = blocks.select(*on, F.col("first").alias("start"), F.col("most").alias("end"), "file", "block", "first", "last")
    wanted = regions.where("end > start").select(*on, "start", "end").distinct()
    return intervals.overlap_join(spans, wanted, bin_size, on).select("file", "block", *on, "first", "last").distinct()


def _starts(found: DataFrame, on: Sequence[str]) -> Column | None:
    """A condition on key and start that holds for the needed blocks' rows: as blocks one by one where they are few, else as one hull a key; none where keys are many too."""
    few = found.select(*on, "first", "last").distinct().limit(RANGES + 1).collect()
    if len(few) > RANGES:
        few = found.groupBy(*on).agg(F.min("first").alias("first"), F.max("last").alias("last")).limit(RANGES + 1).collect()
    if not few or len(few) > RANGES:
        return None
    return reduce(Column.__or__, (reduce(Column.__and__, (F.col(k) == r[k] for k in on), F.col("start").between(r["first"], r["last"])) for r in few))


def read(spark: SparkSession, path: str, regions: DataFrame, on: Sequence[str] = ("chrom",)) -> DataFrame:
    """Rows of the table that some region may need: only the files that the index names, of which the scan skips what their starts rule out.

    The names of needed files come to the driver, as Spark plans a scan by its files.
    """
    found = needed(index(spark, path), regions, on).persist()
    files = [f"{path}/rows/{r['file']}" for r in found.select("file").distinct().collect()]
    table = spark.read.parquet(f"{path}/rows")
    if not files:
        return table.limit(0)
    condition = _starts(found, on)
    found.unpersist()
    rows = spark.read.schema(table.schema).parquet(*files)
    return rows if condition is None else rows.where(condition)


def overlapping(spark: SparkSession, path: str, regions: DataFrame, on: Sequence[str] = ("chrom",), bin_size: int = 1 << 14) -> DataFrame:
    """Each region, with suffix _r, with each of the table's rows that it overlaps."""
    return intervals.overlap_join(read(spark, path, regions, on), regions, bin_size, on)
