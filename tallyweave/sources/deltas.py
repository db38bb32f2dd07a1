"""Keyed tables that change by small delta files, merged when read and compacted now and then."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.versions import Versions


class KeyedTable:
    """Rows by key, of which some columns, such as packed samples and their statistics, are replaced together.

    A version names one base folder and the deltas since, oldest first, so an
    upsert writes no more than its own rows. Writers who meet go one after the
    other. Keys of the base, and of one upsert, are different.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.versions = Versions(spark, path)

    def create(self, rows: DataFrame, key: Sequence[str], replaced: Sequence[str]) -> None:
        number, _ = self.versions.current()
        base = self.versions.write(rows, "base")
        if number or not self.versions.commit(0, {"key": list(key), "replaced": list(replaced), "base": base, "deltas": []}):
            self.versions.drop(base)
            raise ValueError(f"{self.versions.path} is there already")

    def upsert(self, rows: DataFrame) -> None:
        """New values of the replaced columns for some keys; keys that the table lacks are added, with their other columns where rows has them."""
        content = self.versions.current()[1]
        delta = self.versions.write(rows.select(*content["key"], *(c for c in rows.columns if c not in content["key"])), "delta")
        self.versions.update(lambda now: ({**now, "deltas": [*now["deltas"], delta]}, []))

    def _merged(self, content: dict) -> DataFrame:
        key, replaced = content["key"], content["replaced"]
        base = self.versions.read(content["base"])
        if not content["deltas"]:
            return base
        others = [c for c in base.columns if c not in key and c not in replaced]
        parts = []
        for i, folder in enumerate(content["deltas"]):
            delta = self.versions.read(folder)
            new = {c: F.col(c) if c in delta.columns else F.lit(None) for c in others}
            parts.append(delta.select(*key, F.lit(i).alias("_i"), F.struct(*replaced).alias("_new"), F.struct(*(v.cast(base.schema[c].dataType).alias(c) for c, v in new.items()), F.lit(0).alias("_")).alias("_others")))
        last = reduce(DataFrame.unionByName, parts).groupBy(*key).agg(F.max_by("_new", "_i").alias("_new"), F.min_by("_others", "_i").alias("_others"))
        known = base.withColumn("_old", F.lit(True))
        both = known.join(last, key, "full_outer")
        choose = lambda c: F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.col("_new")[c]) if c in replaced else F.when(F.col("_old"), F.col(c)).otherwise(F.col("_others")[c])
        return both.select(*(c if c in key else choose(c).alias(c) for c in base.columns))

    def read(self) -> DataFrame:
        """The rows as of now: the base's, with the last delta of each key."""
        return self._merged(self.versions.current()[1])

    def compact(self) -> None:
        """Write the merged rows as a new base; deltas that come in meanwhile stay deltas.

        The old folders are left to readers that began before; see clean().
        """
        content = self.versions.current()[1]
        if not content["deltas"]:
            return
        base = self.versions.write(self._merged(content), "base")

        def swap(now: dict) -> tuple[dict, list[str]]:
            if now["base"] != content["base"]:
                raise RuntimeError("another compaction was first")
            return {**now, "base": base, "deltas": now["deltas"][len(content["deltas"]) :], "old": [*now.get("old", []), content["base"], *content["deltas"]]}, []

        try:
            self.versions.update(swap)
        except RuntimeError:
            self.versions.drop(base)
            raise

    def clean(self) -> None:
        """Delete the folders that compactions have replaced, once no reader needs them."""
        old: list[str] = []

        def forget(now: dict) -> tuple[dict, list[str]]:
            old[:] = now.get("old", [])
            return {**now, "old": []}, []

        self.versions.update(forget)
        self.versions.drop(*old)


def key_of_line(line: Column) -> Column:
    """The key in a tab-separated line with packed samples: before its first comma, what stands between the last tab and the first colon; null in lines without samples."""
    before = F.regexp_extract(line, r"^([^,]*)\t,", 1)
    return F.when(line.contains("\t,"), F.substring_index(F.substring_index(before, "\t", -1), ":", 1))


def updated_lines(lines: DataFrame, updates: DataFrame, line: str = "line", key: str = "key", new: str = "new") -> DataFrame:
    """Lines of which what follows the key's field, samples and statistics, is replaced by the update of that key; others stay."""
    keyed = lines.withColumn("_key", key_of_line(F.col(line)))
    found = keyed.join(updates.select(F.col(key).alias("_key"), F.col(new).alias("_new")), "_key", "left")
    kept = F.regexp_extract(line, r"^([^,]*\t),", 1)
    return found.select(*(F.when(F.col("_new").isNull(), F.col(line)).otherwise(F.concat(kept, "_new")).alias(c) if c == line else c for c in lines.columns))
