"""The folder that all machines share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one that the cluster names in spark.checkpoint.dir.

    Only where all runs on one machine and none is named, as in tests, one is
    made here; on a cluster that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame, task_rows: int = 0) -> DataFrame:
    """Write df to the shared folder and read it from there.

    With task_rows, no more tasks read it than have so many rows each: few rows
    in many partitions are put together, as the driver keeps some memory for
    every task. Rows are counted as they are written; all are read.
    """
    shared_folder(df.sparkSession)
    if not task_rows:
        return df.checkpoint(eager=True)
    seen = Observation()
    written = df.observe(seen, F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    return written.coalesce(max(1, -(-seen.get["n"] // task_rows)))


def rewritten(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again; clean() deletes what was written."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}.parquet"
    df.sparkSession.sparkContext.__dict__.setdefault("_tallyweave_written", []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def clean(spark: SparkSession) -> int:
    """Delete the tables that rewritten() wrote in this application, once no result that reads them is needed; how many there were."""
    written: list[str] = spark.sparkContext.__dict__.pop("_tallyweave_written", [])
    for path in written:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(written)
