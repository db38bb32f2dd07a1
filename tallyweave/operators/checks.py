"""Checks of inputs and outputs, as tables of what is wrong."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def blanks(rows: DataFrame, line: str, columns: Sequence[str]) -> DataFrame:
    """line and field (from 1) of every empty or null cell."""
    cells = F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    return rows.select(line, F.posexplode(cells).alias("_i", "_v")).where("_v = ''").select(line, (F.col("_i") + 1).alias("field"))


def sparse_matrix(triples: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """One row: entries, rows and columns, whether indices lie inside, and whether the last column is used."""
    m = triples.agg(F.count("*").alias("entries"), F.max("row_idx").alias("_r"), F.max("col_idx").alias("_c"), F.min(F.least("row_idx", "col_idx")).alias("_low"))
    n = rows.agg(F.count("*").alias("rows")).crossJoin(columns.agg(F.count("*").alias("columns")))  # three single rows
    ok = (F.coalesce("_r", F.lit(0)) <= F.col("rows")) & (F.coalesce("_c", F.lit(0)) == F.col("columns")) & (F.coalesce("_low", F.lit(1)) >= 1)
    return m.crossJoin(n).select("entries", "rows", "columns", ok.alias("ok"))


def counts_against(found: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows counted for each key next to what is expected, where the two differ."""
    n = found.groupBy(*key).agg(F.count("*").alias("found"))
    both = n.join(expected.select(*key, "expected"), list(key), "full_outer")
    return both.select(*key, F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("expected", F.lit(0)).alias("expected")).where("found <> expected")


def equal_sums(a: DataFrame, b: DataFrame, by: str, value: str) -> DataFrame:
    """Sums of two tables for each key, where they differ."""
    x, y = (t.groupBy(by).agg(F.sum(value).alias(n)) for t, n in ((a, "left"), (b, "right")))
    return x.join(y, by, "full_outer").where(~F.col("left").eqNullSafe(F.col("right")))


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks."""
    columns = old.columns
    return reduce(lambda x, y: x.unionByName(y), (p.exceptAll(q).withColumn("side", F.lit(s)) for p, q, s in ((old, new.select(columns), "old"), (new.select(columns), old, "new"))))


def incomplete(files: DataFrame, sample: str, expected: int) -> DataFrame:
    """Samples with another number of files than expected."""
    return files.groupBy(sample).agg(F.count("*").alias("files")).where(F.col("files") != expected)


def quarantine(items: DataFrame, good: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Items that a check found good, and the others with the name they are set aside under."""
    return items.join(good, key, "left_semi"), items.join(good, key, "left_anti").withColumn("set_aside_as", F.concat(F.col(key), F.lit(".empty")))


def within(diffs: DataFrame, by: str, most: int) -> DataFrame:
    """Whether each annotation's number of differences is below a bound."""
    return diffs.groupBy(by).agg(F.count("*").alias("differences")).withColumn("ok", F.col("differences") <= most)


def written(df: DataFrame, path: str, by: Sequence[str] = (), **figures: Column) -> dict:
    """Write df as Parquet and return figures over its rows, aggregates that the writing tasks themselves observe."""
    seen = Observation("written")
    df.observe(seen, *(c.alias(name) for name, c in figures.items())).write.partitionBy(*by).parquet(path)
    return seen.get


def matrix_written(triples: DataFrame, path: str, rows: int, columns: int, entries: int | None = None, value: str = "value") -> dict:
    """Write sparse triples and check them in the same job: entries, blanks, the bounds of both indices, and whether all is as expected.

    Indices count from 1; the last column must be used, a row needn't be.
    """
    blank = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "")
    made = written(
        triples, path, entries=F.count(F.lit(1)), blanks=F.count_if(blank("row_idx") | blank("col_idx") | blank(value)),
        first_row=F.min("row_idx"), last_row=F.max("row_idx"), first_column=F.min("col_idx"), last_column=F.max("col_idx"),
    )
    inside = (made["first_row"] or 1) >= 1 and (made["first_column"] or 1) >= 1 and (made["last_row"] or 0) <= rows and (made["last_column"] or 0) == columns
    return {**made, "ok": not made["blanks"] and inside and entries in (None, made["entries"])}
