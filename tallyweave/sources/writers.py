"""Writers: range-sorted tables, split layouts, and text with a preamble."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.ranges import numbered


def compressed_tsv(df: DataFrame, path: str, header: bool = False) -> None:
    df.write.csv(path, sep="\t", header=header, compression="gzip", quote="", emptyValue="")


def range_sorted(df: DataFrame, path: str, by: Sequence[str] = ("chrom", "start"), parts: int | None = None, line: str | None = None) -> None:
    """Parquet in coordinate order, so that a range scan reads few row groups.

    line names a column with the rows' order of arrival: rows alike in `by` keep
    it, as under a stable sort.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*by, line] if line else list(by)
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(path)


def split_by(df: DataFrame, path: str, by: Sequence[str] = ("study_lo", "study", "annotation")) -> None:
    """One folder for each study and annotation, under the study's last two characters."""
    studied = df.withColumn("study_lo", F.right("study", F.lit(2))) if "study_lo" in by and "study_lo" not in df.columns else df
    studied.repartition(*by).write.partitionBy(*by).parquet(path)


def metadata_triplet(tables: dict[str, DataFrame], path: str) -> None:
    """Each metadata table under its name, in folders by study."""
    for name, df in tables.items():
        split_by(df, f"{path}/{name}", ("study_lo", "study"))


def table(df: DataFrame, name: str, bucket_by: Sequence[str] = (), buckets: int = 16) -> None:
    """A catalogue table, bucketed where later joins on the same key should not shuffle."""
    w = df.write.mode("overwrite")
    (w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by) if bucket_by else w).saveAsTable(name)


def with_preamble(df: DataFrame, path: str, preamble: Sequence[str]) -> None:
    """Tab-separated text with ## lines and a header of column names before it, in part-name order."""
    spark = df.sparkSession
    lines = [f"##{x}" for x in preamble] + ["\t".join(df.columns)]
    head = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "line long, value string")
    body = numbered(df, df.columns, "line", len(lines)).select("line", F.concat_ws("\t", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns)).alias("value"))
    head.unionByName(body).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "line").sortWithinPartitions("line").select("value").write.text(path, compression="gzip")
