"""Sample and study metadata: ids, statistics, per-study tables, and column surgery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import scalars
from tallyweave.operators import joins

PROJECT = ("rail_id", "external_id", "study", "project", "organism", "file_source", "metadata_source", "date_processed")


def with_rail_ids(metadata: DataFrame, ids: DataFrame, on: Sequence[str] = ("study", "sample"), strict: bool = True) -> DataFrame:
    """rail_id put before the metadata; strict fails on a sample without one, else such rows go."""
    table = ids.select(*on, "rail_id")
    found = joins.must_match(metadata, table, on, "samples") if strict else metadata.join(table, list(on))
    return found.select("rail_id", *metadata.columns)


def with_junction_statistics(qc: DataFrame, statistics: DataFrame, on: Sequence[str] = ("sample", "study")) -> DataFrame:
    """Quality rows with the junction statistics of their sample; a miss is an error."""
    return joins.must_match(qc, statistics, on, "quality rows")


def per_study(samples: DataFrame, source: DataFrame, qc: DataFrame, organism: str, file_source: str, metadata_source: str, date: str, project: Column) -> dict[str, DataFrame]:
    """The three metadata tables of each study: project, source and quality, keyed alike."""
    key = samples.select("rail_id", F.col("sample").alias("external_id"), "study")
    table = key.select("*", project.alias("project"), F.lit(organism).alias("organism"), F.lit(file_source).alias("file_source"), F.lit(metadata_source).alias("metadata_source"), F.lit(date).alias("date_processed"))
    join = lambda df: key.join(df.withColumnRenamed("sample", "external_id"), ["external_id", "study"]).select("rail_id", "external_id", "study", *(c for c in df.columns if c not in ("sample", "study", "rail_id")))
    return {"project": table.select(*PROJECT), "source": join(source), "qc": join(qc)}


def condensed(positions: Sequence[int]) -> list[tuple[int, int]]:
    """Column positions as ranges of neighbours."""
    out: list[tuple[int, int]] = []
    for p in sorted(set(positions)):
        if out and out[-1][1] == p - 1:
            out[-1] = (out[-1][0], p)
        else:
            out.append((p, p))
    return out


def cut(df: DataFrame, ranges: Sequence[tuple[int, int | None]], complement: bool = False) -> DataFrame:
    """The columns at the given positions, counted from 1; an open range goes to the end. complement drops them."""
    n = len(df.columns)
    chosen = [i for a, b in ranges for i in range(a, min(b or n, n) + 1)]
    keep = [c for i, c in enumerate(df.columns, 1) if (i in chosen) != complement]
    return df.select(*keep)


def pick(df: DataFrame, k: int, seed: int) -> DataFrame:
    """k random rows, for spot checks."""
    return df.orderBy(F.rand(seed)).limit(k)


def update_report(updated: DataFrame, gene: str = "gene_id", by: Sequence[str] = ()) -> DataFrame:
    """How many genes an update changed, and which."""
    changed = updated.where("changed")
    return changed.groupBy(*by).agg(F.count_distinct(gene).alias("genes"), F.sort_array(F.collect_set(gene)).alias("changed_genes"))


def samples_per_study(manifest: DataFrame, study: str = "study") -> DataFrame:
    """How many samples each study has."""
    return manifest.groupBy(study).agg(F.count("*").alias("n"))


def of_source(rows: DataFrame, source: str, column: str = "annotation") -> DataFrame:
    """Rows of one annotation."""
    return rows.where(F.col(column) == source)


def of_studies(rows: DataFrame, studies: Sequence[str], study: str = "study") -> DataFrame:
    """Rows of the studies named, by equality."""
    return rows.where(F.col(study).isin(list(studies)))


def with_intron_sums(qc: DataFrame, sums: DataFrame, total: str, sample: str = "sample") -> DataFrame:
    """Quality rows with their sample's intron sum and its percentage of a total, 0 where either is unknown."""
    joined = qc.join(sums.select(sample, F.col("intron_sum").alias("_s")), sample, "left")
    known = F.col("_s").isNotNull() & (F.coalesce(F.col(total), F.lit(0)) > 0)
    return joined.select(*qc.columns, F.when(known, F.col("_s")).otherwise(F.lit(0)).alias("intron_sum"), F.when(known, F.round(100.0 * F.col("_s") / F.col(total), 2)).otherwise(F.lit(0.0)).alias("intron_sum_percent"))


def annotation_with_lengths(gtf: DataFrame, sums: DataFrame, feature: str, annotations: Sequence[str], exon_key: str = "exon_key") -> DataFrame:
    """GTF rows of one feature that the sums have, scored by their length in bases; the gene id without its annotation.

    Rows are found by gene id, or else by gene id and chromosome.
    """
    at = scalars.gtf_attributes(F.col("attributes"))
    rows = gtf.where(F.col("feature") == feature).withColumn("gene_id", scalars.gene_and_annotation(at["gene_id"], annotations)[0])
    keyed = rows.withColumn("_k1", F.col("gene_id")).withColumn("_k2", F.concat_ws(".", "gene_id", "chrom"))
    found = joins.first_match(keyed, sums.withColumnRenamed("gene_id", "_g"), ["_k1", "_k2"], "_g", "bp_length").where("bp_length is not null")
    exon = F.concat_ws("|", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "strand")
    return found.withColumn("score", F.col("bp_length").cast("string")).withColumn(exon_key, exon).drop("_k1", "_k2", "bp_length")
