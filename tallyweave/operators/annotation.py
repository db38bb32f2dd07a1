"""Annotated junctions and exons from GTF, genePred and other gene models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions import scalars
from tallyweave.operators import intervals, rejoin


def exons_of_gtf(gtf: DataFrame) -> DataFrame:
    """Exons with gene and transcript, of positive length and with both ids."""
    ids = ("gene", "transcript")
    once = F.explode(F.array(F.struct(*(scalars.gtf_attribute(F.col("attributes"), f"{i}_id").alias(i) for i in ids)))).alias("_a")  # a filter isn't pushed below it, so a text is searched once
    rows = gtf.where("feature = 'exon' and start < end").select("chrom", "start", "end", "strand", once)
    return rows.where(" and ".join(f"_a.{i} <> ''" for i in ids)).select("chrom", "start", "end", "strand", *(F.substring(f"_a.{i}", 2, 1 << 30).alias(i) for i in ids))


def merged_exons(exons: DataFrame, gap: int = 2) -> DataFrame:
    """Exons of a transcript joined where less than gap bases part them.

    A transcript's exons are few, so they meet in one task by their transcript,
    where all that follows finds them; coalesce() deals a key's rows by range,
    which is for keys of any share of the rows.
    """
    key = ("transcript", "chrom", "strand")
    rows = exons.where("start is not null and end is not null").repartition("transcript")
    rows = rows.select(*key, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    before = Window.partitionBy("transcript", "chrom", "strand").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    far = rows.withColumn("_far", F.max("end").over(before))
    begin = F.when(F.col("_far").isNull() | (F.col("start") - F.col("_far") >= gap), F.col("start"))
    island = F.max(begin).over(before.rowsBetween(Window.unboundedPreceding, 0))
    return far.withColumn("_island", island).groupBy(*key, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def introns_of_gtf(gtf: DataFrame) -> DataFrame:
    """Introns of all transcripts of a GTF, one-based and closed, with the transcripts that have them."""
    introns = rejoin.previous_exon_introns(merged_exons(exons_of_gtf(gtf)))
    return introns.groupBy("chrom", "start", "end", "strand").agg(F.sort_array(F.collect_set("transcript")).alias("transcripts"))


def introns_of_gene_pred(models: DataFrame) -> DataFrame:
    """Introns of genePred rows (name, chrom, strand, exon_starts, exon_ends)."""
    each = models.select("chrom", "strand", F.col("name").alias("transcript"), F.explode(scalars.gene_pred_introns(F.col("exon_starts"), F.col("exon_ends"))).alias("i"))
    return each.select("chrom", F.col("i.start").alias("start"), F.col("i.end").alias("end"), "strand", "transcript").where("end >= start")


#: Annotation files, but for the numbered releases, and their source codes. Fixed values.
SOURCES = {
    "hg19/refGene.txt.gz": "rG19",
    "hg19/ccdsGene.txt.gz": "cG19",
    "hg19/knownGene.txt.gz": "kG19",
    "hg19/mgcGenes.txt.gz": "mG19",
    "hg19/lincRNAsTranscripts.txt.gz": "lR19",
    "hg19/sibGene.txt.gz": "sG19",
    "hg19/acembly.txt.gz": "aC19",
    "hg19/vegaGene.txt.gz": "vG19",
    "hg38/refGene.txt.gz": "rG38",
    "hg38/ccdsGene.txt.gz": "cG38",
    "hg38/knownGene.txt.gz": "kG38",
    "hg38/mgcGenes.txt.gz": "mG38",
    "hg38/lincRNAsTranscripts.txt.gz": "lR38",
    "hg38/sibGene.txt.gz": "sG38",
    "hg38/chess2.2_assembly.gtf.gz": "cH38",
    "m37/refGene.txt.gz": "rG37",
    "m37/ccdsGene.txt.gz": "cG37",
    "m37/knownGene.txt.gz": "kG37",
    "m37/mgcGenes.txt.gz": "mG37",
    "m37/acembly.txt.gz": "aC37",
    "m37/vegaGene.txt.gz": "vG37",
    "m37/gencode.vM1.annotation.gtf.gz": "gC01",
    "m37/fantom4_all_mrna.gtf.gz": "fM38",
    "m37/fantom4_all_est.gtf.gz": "fE38",
    "m38/refGene.txt.gz": "rG38",
    "m38/ccdsGene.txt.gz": "cG38",
    "m38/knownGene.txt.gz": "kG38",
    "m38/mgcGenes.txt.gz": "mG38",
    "m38/GSE72311_lncrna.gtf.gz": "lR38",
}


def source_codes(last_human: int, last_mouse: int) -> dict[str, str]:
    """Annotation file to source code: SOURCES, and the numbered releases up to the last ones by rule."""
    codes = {f"hg19/gencode.v{i}.annotation.gtf.gz": f"gC{i:02d}" for i in range(3, 20)}
    codes |= {f"hg38/gencode.v{i}.annotation.gtf.gz": f"gC{i:02d}" for i in range(20, last_human + 1)}
    codes |= {f"m38/gencode.vM{i}.annotation.gtf.gz": f"gC{i:02d}" for i in range(2, last_mouse + 1)}
    return codes | SOURCES


def with_source(rows: DataFrame, codes: DataFrame, path: str = "path") -> DataFrame:
    """Rows of a bundle's files with their source's code, by folder and file name; files without a code go."""
    name = F.regexp_extract(F.col(path), r"([^/]+/[^/]+)$", 1)
    return rows.withColumn("_f", name).join(codes.select(F.col("file").alias("_f"), "source"), "_f").drop("_f")


def unite_sources(junctions: DataFrame, sizes: DataFrame | None = None, key: Sequence[str] = ("chrom", "start", "end", "strand"), source: str = "source") -> DataFrame:
    """Each junction once with its sources, sorted and comma-joined; only on known chromosomes if sizes are given."""
    rows = junctions.where("end >= start")
    if sizes is not None:
        rows = rows.join(sizes.select("chrom"), "chrom", "left_semi")
    return rows.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"))


def gtf_statistics(exons: DataFrame) -> DataFrame:
    """Genes, transcripts, and mean lengths of exons, introns and transcripts."""
    length = F.col("end") - F.col("start") + 1
    one = exons.withColumn("_i", rejoin.gap_before())  # an exon with what lies before it, so exons are shuffled once
    per = one.groupBy("gene", "transcript").agg(F.sum(length).alias("_t"), F.count("*").alias("_n"), F.count(length).alias("_exons"), F.sum("_i").alias("_gaps"), F.count("_i").alias("_introns"))
    mean = lambda of, n: F.try_divide(F.sum(of), F.sum(n))
    return per.agg(
        F.count_distinct("gene").alias("genes"), F.count_distinct("transcript").alias("transcripts"), mean("_t", "_exons").alias("exon_length"), mean("_gaps", "_introns").alias("intron_length"),
        F.avg("_t").alias("transcript_length"), F.avg("_n").alias("exons_per_transcript"),
    )


def lift(junctions: DataFrame, chain: DataFrame, bin_size: int = 1 << 17) -> tuple[DataFrame, DataFrame]:
    """Coordinates moved by a table of aligned blocks (chrom, start, end, to_chrom, offset), and what lies in none.

    A junction moves if one block of the plus strand holds all of it.
    """
    half_open = junctions.withColumn("start", F.col("start") - 1)
    hit = intervals.overlap_join(half_open, chain, bin_size).where("start_r <= start and end <= end_r")
    moved = hit.select(F.col("to_chrom_r").alias("chrom"), (F.col("start") + F.col("offset_r") + 1).alias("start"), (F.col("end") + F.col("offset_r")).alias("end"), *(c for c in junctions.columns if c not in ("chrom", "start", "end")))
    found = hit.select("chrom", (F.col("start") + 1).alias("start"), "end").distinct()
    return moved, junctions.join(found, ["chrom", "start", "end"], "left_anti")


def lift_ends(junctions: DataFrame, chains: DataFrame, bin_size: int = 1 << 17, strand: str = "strand") -> tuple[DataFrame, DataFrame]:
    """Junctions moved along chains of aligned blocks, and those that no chain takes.

    chains has a row for each block: chain, score, chrom, start and end (half
    open), and where it goes: to_chrom, to_size, to_strand, to_start, which on
    the minus strand counts from the sequence's end. A junction's first and last
    base are looked up apart, as an intron spans blocks; it moves with the chain
    of the greatest score, ties to the smallest, that has both. On a minus
    strand its ends change places, and its own strand, if it has one, turns.
    Equal rows count once.
    """
    columns, spark = junctions.columns, junctions.sparkSession
    blocks = chains.where("end > start").select(*(F.col(c).alias(f"_{c}") for c in chains.columns))
    n, total = blocks.select(F.count("*"), F.coalesce(F.sum(F.col("_end") - F.col("_start")), F.lit(0))).first()
    lowest = 0  # of blocks much longer than bins, long bins keep the copies few
    while lowest < intervals.LEVELS and total / (bin_size * intervals.LEVEL**lowest) > 4 * n:
        lowest += 1
    low, high = (f("start", "end").cast("long") - 1 for f in (F.least, F.greatest))
    steps = F.ceil(F.log(F.greatest((high - low + 1) / bin_size, F.lit(1.0))) / F.log(F.lit(float(intervals.LEVEL))) - 1e-9)
    level = F.least(F.greatest(steps, F.lit(lowest)), F.lit(intervals.LEVELS)).cast("int")
    size = lambda c: F.lit(bin_size).cast("long") * F.pow(F.lit(intervals.LEVEL), c).cast("long")
    ends = junctions.where("start is not null and end is not null").withColumn("_level", level).withColumn("_bin", F.floor(low / size(F.col("_level"))))
    have = spark.createDataFrame([(r[0],) for r in ends.select("_level").distinct().collect()], "_level int")  # a few numbers
    at = lambda c: F.floor(F.col(c) / size(F.col("_level")))
    blocks = blocks.withColumnRenamed("_chrom", "chrom").crossJoin(F.broadcast(have)).withColumn("_last", F.floor((F.col("_end") - 1) / size(F.col("_level"))))
    of = lambda side, first: blocks.withColumn("_bin", F.explode(F.sequence(first, F.col("_last")))).select("chrom", "_level", "_bin", *(F.col(f"_{c}").alias(f"_{c}_{side}") for c in ("chain", "score", "to_chrom", "to_size", "to_strand", "start", "end", "to_start")))
    key = ["chrom", "_level", "_bin"]
    holds = lambda pos, side: (F.col(f"_start_{side}") < F.col(pos)) & (F.col(pos) <= F.col(f"_end_{side}"))
    # in a bin are blocks that reach into it or the next one, so both ends meet theirs where they are, and rows are shuffled once
    both = ends.join(of("a", at("_start") - 1), key).where(holds("start", "a")).join(of("b", at("_start") - 1), key).where(holds("end", "b"))
    both = both.where((F.col("_chain_a") <= F.col("_chain_b")) & (F.col("_chain_a") >= F.col("_chain_b")))  # the same chain, but no join's key
    minus = F.col("_to_strand_a") == "-"

    def place(pos: str, side: str) -> Column:
        along = F.col(f"_to_start_{side}") + F.col(pos) - 1 - F.col(f"_start_{side}")
        return F.when(minus, F.col(f"_to_size_{side}") - 1 - along).otherwise(along)

    x, y = place("start", "a"), place("end", "b")
    rank = (F.col("_score_a").alias("score"), (-F.col("_chain_a")).alias("chain"))
    best = both.groupBy(*columns, "_level", "_bin").agg(
        F.max(F.struct(*rank, F.greatest(x, y).alias("last"), F.col("_to_chrom_a").alias("to_chrom"), minus.alias("minus"))).alias("_to"),
        F.max(F.struct(*rank, (-F.least(x, y)).alias("first"))).alias("_from"),
    )
    new = {"chrom": F.col("_to.to_chrom"), "start": -F.col("_from.first") + 1, "end": F.col("_to.last") + 1}
    if strand in columns:
        new[strand] = F.when(F.col("_to.minus"), F.translate(strand, "+-", "-+")).otherwise(F.col(strand))
    moved = best.select(*(new.get(c, F.col(c)).alias(c) for c in columns))
    own = F.struct(*columns).alias("own")
    lost = junctions.distinct().select(own).join(best.select(own), "own", "left_anti").select("own.*")
    return moved, lost


def renamed(rows: DataFrame, names: Mapping[str, str], column: str = "chrom") -> DataFrame:
    """Chromosome names as another assembly writes them; others stay."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair)) if names else None
    return rows if table is None else rows.withColumn(column, F.coalesce(table[F.col(column)], column))


def gff_to_gtf(attributes: Column) -> Column:
    """k=v;k=v attributes in GTF's form."""
    return F.regexp_replace(attributes, r"(\w+)=([^;]*);?\s*", '$1 "$2"; ')
