"""The two main computations: junction tables, and gene and exon sums."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave import folders
from tallyweave.functions import scalars
from tallyweave.operators import junctions, matrix, ranges, rejoin


def junction_tables(raw: DataFrame, annotation: DataFrame, chunks: DataFrame, kind: str = "all", chunk_size: int = 65_536, existing: DataFrame | None = None, id: str = "junction_id") -> DataFrame:
    """Raw aligner rows of all samples (with sample and line) to annotated junctions with statistics.

    The junction's own row is merged once over all samples; the steps by run
    group and study that a single machine needs fall away.
    """
    rows = junctions.first_of(junctions.reformat_aligner(raw), ["sample", *junctions.KEY], ["line"])
    long = rows.select(*junctions.KEY, "strand", "motif", "sample", F.lit("").alias("name"), junctions.coverage_of(rows, kind).alias("cov"))
    if existing is not None:
        long = long.unionByName(existing.select(long.columns))
    first = long.groupBy(*junctions.KEY).agg(F.min(F.struct("cov", "strand", "motif", "sample")).alias("_f"))
    stats = junctions.sample_statistics(long)
    found = junctions.look_up_motifs(first.select(*junctions.KEY, F.col("_f.strand").alias("strand")), chunks, chunk_size)
    return ranges.numbered(junctions.annotate(found, annotation).join(stats, list(junctions.KEY)), list(junctions.KEY), id)


#: A piece of an exon: its coordinates and strand.
PIECE = ("chrom", "start", "end", "strand")


def gene_and_exon_sums(sums: DataFrame, exons: DataFrame, samples: DataFrame, gene_edges: DataFrame, exon_edges: DataFrame, gene_map: DataFrame, annotations: Sequence[str], order: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Long (exon_id, sample, sum) rows to gene, exon and intron sums, features with their annotations.

    sums may lack rows, and hold no more than a sample's own file had. exons
    has each exon_id's piece and type, and with order a piece listed again for
    a sample counts once, the first time; introns are summed as they are
    listed, so there it counts again. Rows of samples that aren't listed
    go. The long results hold what was measured; features and studies that lack
    rows count zero in study_rows().
    """
    kept, introns = rejoin.split_types(sums.join(samples.select("sample"), "sample", "left_semi").join(exons, "exon_id"))
    place = ("f_chrom", "f_start", "f_end", "f_strand")
    genes = rejoin.rejoin(kept, gene_edges, PIECE, place, cov="sum", order=order or None)
    exon_sums = rejoin.rejoin(kept, exon_edges, PIECE, place, cov="sum", order=order or None)
    renamed = {f"f_{c}": c for c in PIECE}
    plain = lambda df: df.withColumnsRenamed(renamed)
    features = plain(rejoin.feature_lengths(gene_edges.select(*place, "name", *PIECE).distinct(), place, "name"))
    listed = rejoin.by_gene_map(features.select(*PIECE, "names", "bp_length"), gene_map, annotations)
    exon_features = plain(rejoin.feature_lengths(exon_edges.select(*place, "name", *PIECE).distinct(), place, "name"))
    return {
        "genes": plain(genes).withColumn("start", F.col("start") + 1).join(listed, list(PIECE)).select("gene_id", "annotation", "bp_length", *PIECE, "sample", "sum"),
        "gene_features": listed,
        "exons": plain(exon_sums),
        "exon_features": exon_features,
        "introns": matrix.reduce_axis(introns.withColumnRenamed("sum", "value"), ["sample"]),
    }


def study_rows(long: DataFrame, features: DataFrame, samples: DataFrame, key: Sequence[str], value: str = "sum") -> DataFrame:
    """For each study and feature one array of sums, in the order of the study's samples; what wasn't measured is zero.

    Returns study, the features' columns, samples and counts. A feature's row is
    there for every study, as a study's file lists all features; a study's
    samples are a bounded number, and never columns.
    """
    studies = samples.groupBy("study").agg(F.sort_array(F.collect_set("sample")).alias("samples"))
    places = studies.select("study", F.posexplode("samples").alias("_at", "sample"))
    measured = long.join(places, "sample").select("study", *key, "_at", F.coalesce(F.col(value), F.lit(0).cast("long")).alias("_v"))
    zero = F.lit(0).cast(measured.schema["_v"].dataType)
    found = measured.groupBy("study", *key).agg(F.sort_array(F.collect_list(F.struct("_at", "_v"))).alias("_e"))
    numbered = studies.select("study", "samples").withColumn("_s", F.row_number().over(Window.orderBy("study")))  # one row for each study
    grid = features.withColumn("_s", F.explode(F.sequence(F.lit(1), F.lit(samples.select("study").distinct().count())))).join(numbered, "_s").drop("_s")
    entries = F.coalesce("_e", F.array().cast(found.schema["_e"].dataType))
    rows = grid.join(found, ["study", *key], "left").select("study", *features.columns, "samples", entries.alias("_e"))
    return rows.select("study", *features.columns, "samples", _dense(F.col("_e"), F.size("samples"), zero).alias("counts"))


def _dense(entries: Column, size: Column, zero: Column) -> Column:
    """Sorted entries (_at, _v) as an array of the given size, zero where there is no entry; the work is that size, however many entries there are."""
    before = lambda i: F.when(i > 0, F.get(entries, i - 1)["_at"]).otherwise(-1)
    zeros = lambda n: F.array_repeat(zero, n.cast("int"))
    again = F.raise_error(F.lit("a sample has two values for one feature")).cast("int")
    filled = F.transform(entries, lambda e, i: F.concat(zeros(F.when(e["_at"] > before(i), e["_at"] - before(i) - 1).otherwise(again)), F.array(e["_v"])))
    return F.concat(F.flatten(filled), zeros(size - 1 - before(F.size(entries))))


def write_studies(rows: DataFrame, path: str, columns: Sequence[str], preamble: Sequence[str] = ("annotation", "date.generated"), values: dict[str, str] | None = None, kind: str = "gene_sums", parts: int | None = None) -> None:
    """Text files by study and annotation, in folders named by the study's last two signs, the study and the annotation.

    Each folder's first file begins with ## lines (the annotation and what
    values gives) and a header with the study's samples; lines are in the
    features' order. The rows are written once, then their lines are dealt by
    range over `parts` tasks, so a large study is several files, in the order of
    their names, and no task has one whole; files put together as they are make
    one gzip file of the study.
    """
    by = ("study_lo", "study", "annotation")
    rows = folders.rewritten(rows, "studies").withColumn("study_lo", F.right("study", F.lit(2))).withColumn("kind", F.lit(kind))
    text = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns), F.array_join(F.transform("counts", lambda c: c.cast("string")), "\t"))
    body = rows.select(*by, F.lit(1).alias("_o"), F.struct(*columns).alias("_k"), text.alias("value"))
    first = rows.groupBy(*by).agg(F.first("samples").alias("samples"))
    given = lambda p: F.col("annotation") if p == "annotation" else F.lit((values or {}).get(p, ""))
    lines = [F.concat(F.lit(f"##{p}="), given(p)) for p in preamble] + [F.concat_ws("\t", *map(F.lit, columns), F.array_join("samples", "\t"))]
    none = F.lit(None).cast(body.schema["_k"].dataType)
    head = first.select(*by, F.posexplode(F.array(*lines)).alias("_n", "value")).select(*by, (F.col("_n") - 100).alias("_o"), none.alias("_k"), "value")
    order = (*by, "_o", "_k")
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body.unionByName(head).repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*by, "value").write.partitionBy(*by).text(path, compression="gzip")


def across_tranches(tranches: Sequence[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """The long results of several tranches, each of its own samples, as one."""
    return {name: reduce(DataFrame.unionByName, (t[name] for t in tranches)) for name in ("genes", "exons", "introns")} | {name: tranches[0][name] for name in ("gene_features", "exon_features")}


def exons_by_annotation(exons: DataFrame, masks: DataFrame, annotations: Sequence[str], exon: str = "exon", width: int = 3) -> DataFrame:
    """Each exon as often as each annotation lists it, for different genes: with annotation, and copy counted from 1."""
    listed = masks.select(exon, F.posexplode(scalars.mask_counts(F.col("mask"), width)).alias("_i", "_times")).where("_times > 0")
    names = F.element_at(F.array(*map(F.lit, annotations)), F.col("_i") + 1).alias("annotation")
    return rejoin.replicate(exons.join(listed.select(exon, names, "_times"), exon), "_times").drop("_times")


def exon_splits(tranches: Sequence[tuple[DataFrame, DataFrame]], exons: DataFrame, gene_names: DataFrame, annotations: Sequence[str], exon: str = "exon", value: str = "sum") -> DataFrame:
    """Rows for write_studies() of the exon sums of several tranches: each study's samples from all of them, each exon under every annotation that lists it.

    tranches are pairs of long sums (exon, sample, value) and samples (study,
    sample); gene_names has the annotated genes of each exon. Masks, copies and
    the layout by study and annotation are one plan; sums are joined once and
    never copied with their exons.
    """
    long, samples = (reduce(DataFrame.unionByName, part) for part in zip(*tranches, strict=True))
    masks = rejoin.exon_masks(exons.select(exon).distinct(), gene_names, annotations, exon)
    return study_rows(long, exons_by_annotation(exons, masks, annotations, exon), samples, [exon], value)
