"""Splice junctions of many samples: cleaning, merging, statistics and annotation.

The canonical form is long, one row for each junction and sample; packed lists
are built last, for sinks. A junction's key is its coordinates without strand.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions import scalars

KEY = ("chrom", "start", "end")


def reformat_aligner(raw: DataFrame) -> DataFrame:
    """Aligner rows as junctions: uniques plus multi-mappers, strand signs, and a motif to be filled in."""
    return raw.select(*(c for c in raw.columns if c not in ("strand", "motif", "annotated", "num_uniques", "num_multis", "max_overhang")), F.col("num_uniques").alias("uniques"), (F.col("num_uniques") + F.col("num_multis")).alias("total"), scalars.strand_sign(F.col("strand")).alias("strand"), F.lit("CC-CC").alias("motif"))


def first_of(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order."""
    n = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(n)).where("_n = 1").drop("_n")


def repeats_of(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What first_of leaves out."""
    n = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(n)).where("_n > 1").drop("_n")


def non_canonical(df: DataFrame, motif: str = "motif", strand: str = "strand") -> DataFrame:
    """Junctions with the rarer known motifs, of known strand."""
    return df.where(F.col(motif).rlike("[AG]T-A[GC]") & (F.col(motif) != "GT-AC") & (F.col(strand) != "?"))


def coverage_of(df: DataFrame, kind: str) -> Column:
    """The coverage column of a kind of count; zeros stay."""
    return F.col({"all": "total", "unique": "uniques"}[kind])


def _tie(fields: Sequence[str]) -> Column:
    return F.struct(*(F.col(f).cast("string").alias(f) for f in fields))


def merge_long(rows: DataFrame, key: Sequence[str] = KEY, tie: Sequence[str] = ("name", "cov", "strand", "motif", "sample")) -> DataFrame:
    """Every row with the strand and motif of its junction's first row.

    First means least by the tie fields as text. The first row is a partial
    aggregate joined back, so a junction that most samples share is never
    gathered in one place.
    """
    kept = [c for c in rows.columns if c not in ("strand", "motif")]
    first = rows.groupBy(*key).agg(F.min(_tie(tie)).alias("_first")).select(*key, F.col("_first.strand").alias("strand"), F.col("_first.motif").alias("motif"))
    return rows.select(*kept).join(first, list(key))


def merge_packed(rows: DataFrame, key: Sequence[str] = KEY, tie: Sequence[str] = ("name", "cov", "strand", "motif", "sample")) -> DataFrame:
    """One row for each junction: strand and motif of the first row, and ,sample:cov of all rows in tie order."""
    entries = F.sort_array(F.collect_list(_tie(tie)))
    return rows.groupBy(*key).agg(entries.alias("_e")).select(*key, F.col("_e")[0]["strand"].alias("strand"), F.col("_e")[0]["motif"].alias("motif"), scalars.pack_samples(F.col("_e")).alias("samples"))


def merge_again(parts: Sequence[DataFrame], key: Sequence[str] = KEY, motif: str | None = None) -> DataFrame:
    """Merge already merged tables, with an existing database as one more of them if wished.

    motif names a column that overrides the motif, as after a look-up.
    """
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    if motif:
        rows = rows.withColumn("motif", F.col(motif))
    entries = F.sort_array(F.collect_list(F.struct("strand", "motif", "samples")))
    return rows.groupBy(*key).agg(entries.alias("_e")).select(*key, F.col("_e")[0]["strand"].alias("strand"), F.col("_e")[0]["motif"].alias("motif"), F.array_join(F.transform("_e", lambda e: e["samples"]), "").alias("samples"))


def merge_lifted(rows: DataFrame, offset: int = 0, extra: str | None = None) -> DataFrame:
    """merge_packed after lifting over: the start offset is written out, and one more column passes through."""
    moved = rows.withColumn("start", F.col("start") + offset)
    merged = merge_packed(moved)
    if not extra:
        return merged
    first = moved.groupBy(*KEY).agg(F.min_by(extra, _tie(("name", "cov", "strand", "motif", "sample"))).alias(extra))
    return merged.join(first, list(KEY))


def sample_statistics(rows: DataFrame, key: Sequence[str] = KEY, cov: str = "cov", places: int | None = 3) -> DataFrame:
    """Number of samples, sum, mean and median of the coverage; the last two rounded, or in full where places is None."""
    c = F.col(cov)
    cut = (lambda x: x) if places is None else (lambda x: F.round(x, places))
    return rows.groupBy(*key).agg(F.count(c).alias("count"), F.sum(c).alias("sum"), cut(F.avg(c)).alias("avg"), cut(F.percentile(c, 0.5)).alias("median"))


def repaired(merged: DataFrame, key: Sequence[str], samples: str = "samples") -> DataFrame:
    """Rows of a merged table that share a key joined into one, with its statistics computed anew.

    Lists are joined in the order of their texts; no sample is lost, wherever
    the rows stood.
    """
    joined = merged.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_list(samples)), "").alias(samples))
    covs = F.transform(scalars.unpack_samples(F.col(samples)), lambda e: e["cov"])
    total = F.aggregate(covs, F.lit(0).cast("long"), lambda s, x: s + x)
    ranked, n = F.sort_array(covs), F.size(covs)
    middle = (F.get(ranked, F.floor((n - 1) / 2).cast("int")) + F.get(ranked, F.floor(n / 2).cast("int"))) / 2
    return joined.select(*key, samples, n.cast("long").alias("count"), total.alias("sum"), F.round(total / n, 3).alias("avg"), F.round(middle, 3).alias("median"))


def intersect(sources: Sequence[DataFrame], extras: Sequence[str] = (), key: Sequence[str] = KEY) -> DataFrame:
    """Junctions that every source has, with the strand of the first and the extra fields of each source in turn."""
    tagged = [s.select(*key, "strand", F.lit(i).alias("_i"), F.struct(*extras).alias("_x") if extras else F.lit(0).alias("_x")) for i, s in enumerate(sources)]
    rows = reduce(lambda a, b: a.unionByName(b), tagged)
    picked = [F.max(F.when(F.col("_i") == i, F.col("_x"))).alias(f"_x{i}") for i in range(len(sources))]
    found = rows.groupBy(*key).agg(F.min_by("strand", F.struct("_i", "strand")).alias("strand"), F.count_distinct("_i").alias("_n"), *picked).where(F.col("_n") == len(sources))
    return found.select(*key, "strand", *(F.col(f"_x{i}.{x}").alias(f"{x}_{i + 1}") for i in range(len(sources)) for x in extras))


def _sources(annotation: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    listed = annotation.select(*key, F.explode(F.split(F.coalesce("sources", F.lit("all")), ",")).alias("_s"))
    return listed.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_set("_s")), ",").alias(name))


def annotate(junctions: DataFrame, annotation: DataFrame) -> DataFrame:
    """Length, motif halves, whether the junction is annotated (1 or 0) and the sources of either splice site, 0 if none.

    Strand is not compared. The annotation is aggregated before the joins, so
    each is on unique keys; Spark broadcasts it where its size allows.
    """
    known = annotation.select(*KEY).distinct().withColumn("_known", F.lit(1))
    left, right = _sources(annotation, ("chrom", "start"), "left_annotated"), _sources(annotation, ("chrom", "end"), "right_annotated")
    a, b = scalars.motif_sides(F.col("motif"))
    out = junctions.join(known, list(KEY), "left").join(left, ["chrom", "start"], "left").join(right, ["chrom", "end"], "left")
    return out.select(
        *junctions.columns, (F.col("end") + 1 - F.col("start")).alias("length"), F.coalesce("_known", F.lit(0)).alias("annotated"), a.alias("left_motif"), b.alias("right_motif"),
        F.coalesce("left_annotated", F.lit("0")).alias("left_annotated"), F.coalesce("right_annotated", F.lit("0")).alias("right_annotated"),
    )


def genome_chunks(sequences: DataFrame, size: int = 65_536) -> DataFrame:
    """(chrom, seq) as (chrom, chunk, seq) with one base of overlap on the right."""
    n = F.floor((F.greatest(F.length("seq"), F.lit(1)) - 1) / size).cast("int")
    return sequences.select("chrom", F.explode(F.sequence(F.lit(0), n)).alias("chunk"), "seq").select("chrom", "chunk", F.substr("seq", F.col("chunk") * size + 1, F.lit(size + 1)).alias("seq"))


def look_up_motifs(junctions: DataFrame, chunks: DataFrame, size: int = 65_536, unknown: bool = True) -> DataFrame:
    """The two bases at either end of each intron (one-based, closed), as xx-yy in the genome's case.

    A junction on a chromosome that the chunks lack, or that reaches beyond its
    end, has a null motif; with unknown=False such rows go.
    """
    columns = junctions.columns
    for name, at in (("_left", F.col("start")), ("_right", F.col("end") - 1)):
        side = chunks.select("chrom", F.col("chunk").cast("long").alias(name + "_chunk"), F.col("seq").alias(name + "_seq"))
        junctions = junctions.withColumn(name + "_chunk", F.floor((at - 1) / size)).join(side, ["chrom", name + "_chunk"], "left" if unknown else "inner")
        two = F.substr(F.col(name + "_seq"), ((at - 1) % size + 1).cast("int"), F.lit(2))
        junctions = junctions.withColumn(name, F.when((at > 0) & (F.length(two) == 2), two)).drop(name + "_chunk", name + "_seq")
    found = junctions.select(*columns, F.concat("_left", F.lit("-"), "_right").alias("motif"))
    return found if unknown else found.where("motif is not null")


def consolidate_bed12(rows: DataFrame) -> DataFrame:
    """BED12 junctions moved inside their blocks, scores of equal coordinates added, the last strand kept."""
    sizes = F.split("block_sizes", ",")
    moved = rows.select("chrom", (F.col("start") + sizes[0].cast("long") + 1).alias("start"), (F.col("end") - sizes[1].cast("long")).alias("end"), "score", "strand")
    return moved.groupBy(*KEY).agg(F.sum("score").alias("score"), F.max("strand").alias("strand"), F.lit("GT-AG").alias("motif"))


def sample_totals(samples: DataFrame, rows: DataFrame, sample: str = "sample", cov: str = "cov") -> DataFrame:
    """Junctions, coverage and mean coverage of every sample, zero for samples without a junction."""
    n = rows.groupBy(sample).agg(F.count("*").alias("_n"), F.sum(cov).alias("_c"))
    out = samples.join(n, sample, "left")
    count, total = F.coalesce("_n", F.lit(0)), F.coalesce("_c", F.lit(0))
    return out.select(*samples.columns, count.alias("junction_count"), total.alias("coverage"), F.when(count > 0, F.round(total / count, 3)).otherwise(F.lit(0.0)).alias("avg"))
