"""Disjoint-exon sums carried back to the annotated exons and genes they belong to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions import scalars
from tallyweave.operators.junctions import first_of


def split_types(counts: DataFrame, kind: str = "type") -> tuple[DataFrame, DataFrame]:
    """Exon rows, and the intron rows (type 1) that are put aside."""
    return counts.where(F.col(kind) != 1), counts.where(F.col(kind) == 1)


def from_zero(counts: DataFrame, start: str = "start") -> DataFrame:
    """One-based starts as those of half-open intervals, for counts whose mapping is in BED coordinates."""
    return counts.withColumn(start, F.col(start) - 1)


def rejoin(counts: DataFrame, edges: DataFrame, key: Sequence[str], feature: Sequence[str], sample: str = "sample", cov: str = "cov", order: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """Sum of each feature's disjoint pieces for each sample.

    With order, a piece listed twice for a sample counts once, the first time.
    Pieces without a feature add nothing, or are an error if strict; unmapped()
    lists them.
    """
    if strict and (lost := unmapped(counts, edges, key).take(1)):
        raise ValueError(f"pieces without a feature, such as {lost[0]}")
    if order:
        counts = first_of(counts, [*key, sample], order)
    return counts.join(edges.select(*key, *feature).distinct(), list(key)).groupBy(*feature, sample).agg(F.sum(cov).alias(cov))


def unmapped(counts: DataFrame, edges: DataFrame, key: Sequence[str]) -> DataFrame:
    return counts.join(edges.select(*key).distinct(), list(key), "left_anti")


def feature_lengths(edges: DataFrame, feature: Sequence[str], name: str, start: str = "start", end: str = "end") -> DataFrame:
    """Bases of each feature's pieces under each name, the largest over its names, and the names joined."""
    per_name = edges.select(*feature, name, start, end).distinct().groupBy(*feature, name).agg(F.sum(F.col(end) - F.col(start)).alias("_l"))
    return per_name.groupBy(*feature).agg(F.max("_l").alias("bp_length"), F.array_join(F.sort_array(F.collect_set(name)), ";").alias("names"))


def genes_by_annotation(genes: DataFrame, annotations: Sequence[str], name: str = "name") -> DataFrame:
    """Gene rows with gene_id and annotation from their names; the first row of each pair by coordinate stays.

    Names are ;-joined; starts become one-based.
    """
    exploded = genes.withColumn(name, F.explode(F.split(name, ";")))
    gene, annotation = scalars.gene_and_annotation(F.col(name), annotations)
    out = exploded.withColumn("gene_id", gene).withColumn("annotation", annotation).where("annotation is not null").withColumn("start", F.col("start") + 1)
    return first_of(out, ["gene_id", "annotation"], ["chrom", "start", "end"])


def by_gene_map(rows: DataFrame, gene_map: DataFrame, annotations: Sequence[str], names: str = "names") -> DataFrame:
    """Rejoined gene rows for each annotation that the gene map has for their place, strand and gene.

    names are ;-joined; a name without a known annotation gives no row, nor
    does a gene that the map lacks at that place. Starts of both sides, half
    open, become one-based. The first row of each gene and annotation by
    coordinate stays.
    """
    place = ["chrom", "start", "end", "strand"]

    def named(table: DataFrame, column: str) -> DataFrame:
        gene, annotation = scalars.gene_and_annotation(F.col(column), annotations)
        return table.withColumn("gene_id", gene).withColumn("annotation", annotation).where("annotation is not null").withColumn("start", F.col("start") + 1)

    known = named(gene_map.select(*place, "name"), "name").select(*place, "gene_id", "annotation").distinct()
    found = named(rows.withColumn("_name", F.explode(F.split(names, ";"))), "_name").drop("_name", "annotation", names)
    return first_of(found.join(known, [*place, "gene_id"]), ["gene_id", "annotation"], ["chrom", "start", "end"])


def sums_by_gene_list(sums: DataFrame, genes: DataFrame, row: str = "exon_id", cov: str = "cov", sample: Sequence[str] = ("sample",)) -> DataFrame:
    """Gene sums from exon sums and a list of each exon's genes, joined on the exon's id and not by place in a file."""
    return sums_of_listed_genes(sums.join(genes.select(row, "gene_ids"), row), cov=cov, sample=sample)


def exon_masks(exons: DataFrame, gene_names: DataFrame, annotations: Sequence[str], exon: str = "exon") -> DataFrame:
    """How often each annotation holds an exon, as a column for each and as a digit mask."""
    known = gene_names.withColumn("annotation", scalars.last_annotation(F.col("gene"), annotations)).where("annotation is not null")
    counted = exons.join(known, exon).groupBy(exon).pivot("annotation", list(annotations)).agg(F.count(F.lit(1)))
    zeros = [F.coalesce(F.col(f"`{a}`"), F.lit(0)).cast("int") for a in annotations]
    return counted.select(exon, *(z.alias(a) for z, a in zip(zeros, annotations, strict=True)), scalars.digit_mask(F.array(*zeros)).alias("mask"))


def replicate(rows: DataFrame, times: Column | str) -> DataFrame:
    """Each row as often as times says, numbered from 1; rows with none or less go."""
    n = F.col(times) if isinstance(times, str) else times
    return rows.where(n > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), n.cast("int"))))


def sums_of_listed_genes(exons: DataFrame, genes: str = "gene_ids", cov: str = "cov", sample: Sequence[str] = ()) -> DataFrame:
    """Gene sums from exons that name several genes, comma-separated."""
    return exons.withColumn("gene_id", F.explode(F.split(genes, ","))).groupBy("gene_id", *sample).agg(F.sum(cov).alias(cov))


def exon_makeup(exons: DataFrame, gene: str = "gene_id") -> DataFrame:
    """Each gene's exons as start-end;start-end and their number."""
    listed = F.sort_array(F.collect_set(F.struct("start", "end")))
    return exons.groupBy(gene).agg(listed.alias("_e")).select(gene, F.array_join(F.transform("_e", lambda e: F.concat_ws("-", e["start"].cast("string"), e["end"].cast("string"))), ";").alias("makeup"), F.size("_e").alias("exons"))


def differing_makeup(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Features of equal coordinates whose exons differ, and whether the new ones hold all of the old."""
    both = old.select(*key, F.col("makeup").alias("old")).join(new.select(*key, F.col("makeup").alias("new")), list(key)).where("old <> new")
    return both.withColumn("contained", F.size(F.array_except(F.split("old", ";"), F.split("new", ";"))) == 0)


def in_order(rows: DataFrame, order: DataFrame, key: str, position: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows in the order that a table gives, with the keys that either side alone has."""
    joined = rows.join(order.select(key, position), key).orderBy(position)
    return joined, rows.join(order, key, "left_anti"), order.join(rows, key, "left_anti")


def updated(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Old rows with the new values where there are any; changed tells where they differ."""
    fresh = new.select(*key, *(F.col(c).alias(f"_{c}") for c in columns))
    out = old.join(fresh, list(key), "left")
    changed = [F.coalesce(~F.col(f"_{c}").eqNullSafe(F.col(c)) & F.col(f"_{c}").isNotNull(), F.lit(False)) for c in columns]
    any_change = changed[0]
    for c in changed[1:]:
        any_change = any_change | c
    return out.select(*key, *(F.coalesce(f"_{c}", c).alias(c) for c in columns), *(c for c in old.columns if c not in (*key, *columns)), any_change.alias("changed"))


def guarded_update(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str], guard: Sequence) -> DataFrame:
    """updated(), which fails if it would change a guarded key: one whose counts must be the same after any update."""
    out = updated(old, new, [key], columns)
    if broken := out.where(F.col(key).isin(list(guard)) & F.col("changed")).take(1):
        raise ValueError(f"counts of {broken[0][key]} must not change")
    return out


def gap_before(transcript: str = "transcript") -> Column:
    """Bases between a transcript's exon and the one before it, null where there are none."""
    gap = F.col("start") - F.lag("end").over(Window.partitionBy(transcript).orderBy("start", "end")) - 1
    return F.when(gap > 0, gap)


def previous_exon_introns(exons: DataFrame, transcript: str = "transcript") -> DataFrame:
    """Introns between a transcript's exons: from one past an exon to one before the next."""
    before = F.lag("end").over(Window.partitionBy(transcript).orderBy("start", "end"))
    return exons.select(transcript, "chrom", "strand", (before + 1).alias("start"), (F.col("start") - 1).alias("end")).where("start is not null and end >= start")
