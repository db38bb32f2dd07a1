"""Between long, wide, packed and sparse forms, and sums over either side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import scalars
from tallyweave.operators.ranges import numbered


def reduce_axis(long: DataFrame, by: Sequence[str], value: str = "value", how: str = "sum") -> DataFrame:
    """Sum or mean over the rows of each column, or over the columns of each row, as `by` says."""
    return long.groupBy(*by).agg((F.sum if how == "sum" else F.avg)(value).alias(value))


def sparse(long: DataFrame, row: Sequence[str], column: str, value: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Triples (row_idx, col_idx, value), and the dimension tables of rows and columns, counted from 1."""
    rows = numbered(long.select(*row).distinct(), row, "row_idx", 1)
    columns = numbered(long.select(column).distinct(), [column], "col_idx", 1)
    return long.join(rows, list(row)).join(columns, column).select("row_idx", "col_idx", value), rows, columns


#: Columns of a junction table's row attributes, in order. Fixed values.
ROW_ATTRIBUTES = ("chromosome", "start", "end", "length", "strand", "annotated", "left_motif", "right_motif", "left_annotated", "right_annotated")


def row_attributes(rows: DataFrame, junctions: DataFrame, key: Sequence[str] = ("chrom", "start", "end")) -> DataFrame:
    """The ten attributes of each matrix row, with row_idx, from annotated junctions by the rows' key."""
    return rows.join(junctions.withColumn("chromosome", F.col("chrom")), list(key)).select("row_idx", *ROW_ATTRIBUTES)


def packed_to_long(packed: DataFrame, samples: str = "samples", kind: str = "string") -> DataFrame:
    """A row for each entry of a packed list; kind is the type of sample ids."""
    keep = [c for c in packed.columns if c != samples]
    return packed.select(*keep, F.explode(scalars.unpack_samples(F.col(samples))).alias("_e")).select(*keep, F.col("_e.sample").cast(kind).alias("sample"), "_e.cov")


def wide_to_packed(wide: DataFrame, key: Sequence[str], samples: Sequence[str]) -> DataFrame:
    """Positive counts of each row as ,sample:count in column order; none gives an empty text."""
    entries = F.array(*(F.struct(F.lit(s).alias("sample"), F.col(f"`{s}`").alias("cov")) for s in samples))
    return wide.select(*key, scalars.pack_samples(F.filter(entries, lambda e: e["cov"] > 0)).alias("samples"))


def long_to_wide(long: DataFrame, key: Sequence[str], column: str, value: str, columns: Sequence) -> DataFrame:
    """One column for each listed sample, zero where there is no value."""
    return long.groupBy(*key).pivot(column, list(columns)).agg(F.sum(value)).na.fill(0)


def positions_to_packed(wide: DataFrame, key: Sequence[str], counts: str, positions: DataFrame) -> DataFrame:
    """An array of counts for each row as ,id:count of its positive ones, in array order.

    positions maps places in the array, counted from 0, to ids; rows without a
    positive count keep an empty text, and places without an id are left out.
    """
    each = wide.select(*key, F.posexplode(counts).alias("position", "cov")).where("cov > 0").join(positions.select("position", "id"), "position")
    packed = each.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("position", F.col("id").alias("sample"), "cov"))).alias("_e")).select(*key, scalars.pack_samples(F.col("_e")).alias("samples"))
    return wide.select(*key).join(packed, list(key), "left").withColumn("samples", F.coalesce("samples", F.lit("")))


def renamed_columns(wide: DataFrame, names: DataFrame, id: str = "rail_id", to: str = "accession") -> DataFrame:
    """A wide table whose sample columns are numbers, headed by accessions instead; other columns stay.

    The table of names is read for the columns that the table has, so what
    comes to the driver is as long as its header.
    """
    numbers = [int(c) for c in wide.columns if c.isdigit()]
    found = {str(r[0]): r[1] for r in names.where(F.col(id).isin(numbers)).select(id, to).collect()}
    if lost := [c for c in map(str, numbers) if c not in found]:
        raise ValueError(f"columns without a name, such as {lost[0]}")
    return wide.select(*(F.col(f"`{c}`").alias(found.get(c, c)) for c in wide.columns))


def filled(long: DataFrame, rows: DataFrame, row: str, value: str = "value") -> DataFrame:
    """Every row of the dimension, with zero where nothing was measured."""
    return rows.join(long, row, "left").withColumn(value, F.coalesce(value, F.lit(0)))


def concatenated(parts: DataFrame, key: Sequence[str], order: str, samples: str = "samples") -> DataFrame:
    """Packed lists of several studies joined for each row, in the studies' order."""
    return parts.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, samples))), lambda x: x[samples]), "").alias(samples))


def whole_number_stats(values: DataFrame, value: str) -> DataFrame:
    """Mean rounded down, mode (the smallest of several), its count, and the total of whole numbers."""
    each = values.groupBy(value).agg(F.count("*").alias("_n"))
    return each.agg(F.floor(F.sum(F.col(value) * F.col("_n")) / F.sum("_n")).cast("long").alias("avg"), F.max(F.struct(F.col("_n"), (-F.col(value)).alias("v"))).alias("_m"), F.sum(F.col(value) * F.col("_n")).alias("total")).select("avg", (-F.col("_m.v")).alias("mode"), F.col("_m._n").alias("mode_count"), "total")
