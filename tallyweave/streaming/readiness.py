"""Studies that become ready as their samples finish, each passed on once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

if TYPE_CHECKING:
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import TimerValues

MARKER = "study string, sample string"


def markers(spark: SparkSession, path: str, schema: str = MARKER, fmt: str = "json", per_trigger: int = 1000) -> DataFrame:
    """Completion markers as they appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(path)


def done_counts(stream: DataFrame, study: str = "study", sample: str = "sample") -> DataFrame:
    """Finished samples of each study; a marker that comes twice counts once."""
    return stream.dropDuplicates([study, sample]).groupBy(study).agg(F.count("*").alias("n"))


def counts_of(stream: DataFrame, folder: str, study: str = "study", sample: str = "sample") -> DataFrame:
    """Finished samples of each study once all of the stream that there is has been read.

    Each batch's updates are written as Parquet under the folder, in a place of
    its own, so a batch that runs again overwrites itself; the largest count of
    a study is its last.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/counts/batch={number}")

    done_counts(stream, study, sample).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/progress").foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/counts").groupBy(study).agg(F.max("n").alias("n"))


#: How long, in milliseconds, a study that was passed on is remembered against markers that come again.
REMEMBERED = 30 * 24 * 3600 * 1000

#: What a query with keyed state is started with: its state store, and no batches without data, of which there would be no end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class _Study(StatefulProcessor):
    """A study's samples until all are there; then only that it was passed on, for a while."""

    def __init__(self, sample: str, remembered: int):
        self.sample, self.remembered = sample, remembered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "sample string", "there boolean")
        self.count = handle.getValueState("count", "n long")
        self.passed = handle.getValueState("passed", "n long", self.remembered)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: TimerValues) -> Iterator[pd.DataFrame]:
        import pandas as pd

        if self.passed.exists():
            for _ in rows:
                pass
            return
        n, expected = (self.count.get()[0] if self.count.exists() else 0), None
        for part in rows:
            expected = int(part["expected_samples"].iloc[-1])
            for sample in part[self.sample].dropna().unique():
                if not self.seen.containsKey((str(sample),)):
                    self.seen.updateValue((str(sample),), (True,))
                    n += 1
        if expected is not None and n >= expected:
            self.seen.clear()
            self.count.clear()
            self.passed.update((n,))
            yield pd.DataFrame({"study": [key[0]], "n": [n]})
        else:
            self.count.update((n,))


def ready_once(stream: DataFrame, expected: DataFrame, study: str = "study", sample: str = "sample", remembered: int = REMEMBERED) -> DataFrame:
    """(study, n) of each study, once, when as many different samples of it have come as are expected.

    A study's samples are kept in the state store one by one, and go when it is
    passed on; what stays is that it was, for `remembered` milliseconds. Markers
    of studies that aren't expected are left out, null samples count nothing.
    The stream must be started inside keyed_state().
    """
    known = stream.select(F.col(study).cast("string").alias(study), F.col(sample).cast("string").alias(sample)).join(expected.select(F.col(study).cast("string").alias(study), F.col("n").alias("expected_samples")), study)
    out = known.groupBy(study).transformWithStateInPandas(_Study(sample, remembered), outputStructType="study string, n long", outputMode="Append", timeMode="ProcessingTime")
    return out.withColumnRenamed("study", study)


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """SETTINGS for queries that are started inside; the session's own come back."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start(stream: DataFrame, expected: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str, study: str = "study", sample: str = "sample", once: bool = True) -> StreamingQuery:
    """Call act with the studies that have become ready and the batch's number.

    Each study is in one batch only. act is called at least once for a batch:
    if it or the driver fails before the batch is committed, the batch runs
    again, with the same studies and the same number, by which act can tell.
    write_ready() passes each study on exactly once.
    """
    with keyed_state(stream.sparkSession):
        writer = ready_once(stream, expected, study, sample).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(act)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def write_ready(stream: DataFrame, expected: DataFrame, path: str, checkpoint: str, study: str = "study", sample: str = "sample", once: bool = True) -> StreamingQuery:
    """Ready studies as Parquet rows, by Spark's own file sink, whose log makes each row appear exactly once."""
    with keyed_state(stream.sparkSession):
        writer = ready_once(stream, expected, study, sample).writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet").option("path", path)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def ready_in(counts: DataFrame, expected: DataFrame, study: str = "study") -> DataFrame:
    return counts.join(expected.select(study, F.col("n").alias("_e")), study).where("n = _e").select(study, "n")
