"""Stable numeric ids for samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions import scalars
from tallyweave.versions import Versions


def assign(samples: DataFrame, compilation: int, order: str, counters: DataFrame | None = None, accession: str = "accession") -> DataFrame:
    """rail_id = compilation (8 bits), accession prefix (12 bits), and a counter that goes on from the saved one."""
    prefixed = samples.withColumn("prefix", scalars.accession_bits(F.col(accession)))
    if counters is not None:
        prefixed = prefixed.join(counters.select("prefix", F.col("counter").alias("_from")), "prefix", "left")
    else:
        prefixed = prefixed.withColumn("_from", F.lit(0))
    n = F.row_number().over(Window.partitionBy("prefix").orderBy(order)) - 1 + F.coalesce("_from", F.lit(0))
    bits = F.lpad(F.bin(F.lit(compilation)), 8, "0")
    return prefixed.withColumn("counter", n.cast("long")).withColumn("rail_id", scalars.bits_to_long(bits, F.col("prefix"), F.bin("counter"))).drop("_from")


def next_counters(assigned: DataFrame, counters: DataFrame | None = None) -> DataFrame:
    """The state for the next run: each prefix's first free counter."""
    new = assigned.groupBy("prefix").agg((F.max("counter") + 1).alias("counter"))
    return (new.unionByName(counters.select("prefix", "counter")) if counters is not None else new).groupBy("prefix").agg(F.max("counter").alias("counter"))


def clashes(assigned: DataFrame) -> DataFrame:
    """Ids given twice: none, unless counters outgrow their bits."""
    return assigned.groupBy("rail_id").agg(F.count("*").alias("n")).where("n > 1")


def assign_saved(samples: DataFrame, compilation: int, order: str, state: str, accession: str = "accession", key: Sequence[str] = ("accession",), tries: int = 20) -> DataFrame:
    """assign() with the counters that a folder keeps from run to run, and from writer to writer.

    Counters and given ids are one version of the folder (see versions): of two
    writers at a time the second one starts again from the first one's
    counters, so no id is given twice. A sample that has an id, by the key
    columns, keeps it, so a run that is repeated changes nothing.
    """
    kept = Versions(samples.sparkSession, state)
    columns = [*key, "prefix", "counter", "rail_id"]

    def make(content: dict) -> tuple[dict, list[str]]:
        counters = kept.read(content["counters"]) if content else None
        new = samples
        for folder in content.get("given", []):
            new = new.join(kept.read(folder), list(key), "left_anti")
        given = kept.write(assign(new.dropDuplicates(list(key)), compilation, order, counters, accession).select(columns), "given")
        state_of = kept.write(next_counters(kept.read(given), counters).coalesce(1), "counters")
        return {"counters": state_of, "given": [*content.get("given", []), given]}, [given, state_of]

    content = kept.update(make, tries)
    known = reduce(DataFrame.unionByName, (kept.read(f) for f in content["given"]))
    return samples.join(known, list(key))
