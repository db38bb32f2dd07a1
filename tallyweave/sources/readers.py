"""Readers of the file kinds that quantification pipelines leave behind."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyweave import folders
from tallyweave.functions import scalars
from tallyweave.sources import frames

ALIGNER = "chrom string, start long, end long, strand int, motif int, annotated int, num_uniques long, num_multis long, max_overhang long"
GTF = "chrom string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"
BED12 = "chrom string, start long, end long, name string, score long, strand string, thick_start long, thick_end long, rgb string, blocks int, block_sizes string, block_starts string"
EXON_SUMS = "chrom string, start long, end long, sum long"


def tsv(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """Tab-separated rows with the file each came from; plain or gzip."""
    return spark.read.csv(paths if isinstance(paths, str) else list(paths), sep="\t", schema=schema, mode="PERMISSIVE").withColumn("path", F.col("_metadata.file_path"))


def zstd_tsv(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], part_bytes: int = frames.PART_BYTES) -> DataFrame:
    """Zstandard-compressed tab-separated text as string columns, with path and line, read in parts of whole frames."""
    fields = F.split("value", "\t")
    return frames.zstd_lines(spark, paths, part_bytes).select(*(F.get(fields, F.lit(i)).alias(n) for i, n in enumerate(names)), "path", "line")


def with_samples(rows: DataFrame, manifest: DataFrame, parts: int = 1) -> DataFrame:
    """Rows with their sample from a manifest of (file, sample), matched by file name, or by so many last parts of the path."""
    name = lambda c: F.regexp_extract(c, r"((?:[^/]+/){%d}[^/]+)$" % (parts - 1), 1)
    return rows.withColumn("_f", name("path")).join(manifest.select(name("file").alias("_f"), "sample"), "_f").drop("_f")


def junction_bed(spark: SparkSession, paths: str | Sequence[str], rest: str = "") -> DataFrame:
    """BED-like junctions: header lines and rows of too few or wrong fields are left out. rest names further columns."""
    schema = "chrom string, start string, end string, name string, score string, strand string, splice_site string" + (f", {rest}" if rest else "")
    rows = tsv(spark, paths, schema).where("chrom <> 'chrom'")
    rows = rows.withColumn("start", F.col("start").try_cast("long")).withColumn("end", F.col("end").try_cast("long"))
    return rows.where("start is not null and end is not null").select("chrom", "start", "end", "name", F.col("score").alias("cov"), "strand", F.col("splice_site").alias("motif"), *(x.split()[0] for x in rest.split(",") if x), "path")


def merged_junctions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return tsv(spark, paths, "chrom string, start long, end long, strand string, motif string, samples string").drop("path")


def fasta_chunks(spark: SparkSession, paths: str | Sequence[str], size: int = 65_536) -> DataFrame:
    """(chrom, chunk, seq) of each record, one base of overlap on the right, cut while the lines are read.

    A task joins the lines of its split into segments of about `size` bases; the
    segments' lengths, small rows, give each its place, and pieces of segments
    make up the chunks. So no row holds a whole chromosome.
    """

    def join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        out: list[tuple] = []
        held: list[str] = []
        at, n, bases = (None, None), 0, 0

        def close() -> None:
            nonlocal held, n, bases
            if held:
                out.append((*at, n, None, "".join(held)))
                held, n, bases = [], n + 1, 0

        def rows() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["path", "block", "n", "head", "seq"])
                out.clear()

        for b in batches:
            for path, block, line in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if at != (path, block):
                    close()
                    at, n = (path, block), 0
                if line.startswith(">"):
                    close()
                    out.append((*at, n, (line[1:].split() or [""])[0], ""))
                    n += 1
                elif line := line.strip():
                    held.append(line)
                    bases += len(line)
                    if bases >= size:
                        close()
            yield from rows()
        close()
        yield from rows()

    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    segments = folders.rewritten(lines.mapInArrow(join_lines, "path string, block long, n long, head string, seq string"), "fasta")
    order = Window.partitionBy("path").orderBy("block", "n")
    placed = segments.select("path", "block", "n", "head", F.length("seq").cast("long").alias("len"))  # without bases: one small row for each 64 kB
    placed = placed.withColumn("chrom", F.last("head", ignorenulls=True).over(order)).withColumn("_r", F.count("head").over(order))
    inside = Window.partitionBy("path", "_r").orderBy("block", "n").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("at", F.coalesce(F.sum("len").over(inside), F.lit(0))).where("len > 0 and chrom is not null")
    rows = segments.select("path", "block", "n", "seq").join(placed.select("path", "block", "n", "chrom", "at", "len"), ["path", "block", "n"])
    # a segment's piece of each chunk that it touches, the chunk's overlap included
    first = F.greatest(F.floor((F.col("at") - 1) / size), F.lit(0))
    cut = rows.withColumn("chunk", F.explode(F.sequence(first, F.floor((F.col("at") + F.col("len") - 1) / size))))
    begin = F.greatest(F.col("chunk") * size, F.col("at"))
    stop = F.least((F.col("chunk") + 1) * size + 1, F.col("at") + F.col("len"))
    pieces = cut.withColumn("_b", begin).withColumn("_e", stop).where("_e > _b")
    pieces = pieces.select("chrom", "chunk", "_b", F.substr("seq", (F.col("_b") - F.col("at") + 1).cast("int"), (F.col("_e") - F.col("_b")).cast("int")).alias("_s"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_b", "_s"))), lambda x: x["_s"]), "")
    return pieces.groupBy("chrom", F.col("chunk").cast("int").alias("chunk")).agg(whole.alias("seq")).where(F.length("seq") > 0)


def chromosome_sizes(chunks: DataFrame, size: int = 65_536) -> DataFrame:
    """Bases of each chromosome, from its chunks."""
    return chunks.groupBy("chrom").agg(F.max(F.col("chunk").cast("long") * size + F.least(F.length("seq"), F.lit(size))).alias("size"))


def sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, size long")


def exon_sums(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, line, sum) of per-sample sums, of which only the fourth column is read; line counts rows of a file from 0.

    A file may be read in several splits: rows are numbered inside each, in
    which they come in order, and the sizes of a file's splits before, by where
    they begin, lift the numbers.
    """
    block = F.col("_metadata.file_block_start").alias("block")
    sums = spark.read.csv(paths if isinstance(paths, str) else list(paths), sep="\t", schema=EXON_SUMS).select("sum", F.col("_metadata.file_path").alias("path"), block, F.monotonically_increasing_id().alias("_m"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row for each split
    splits = sums.groupBy("path", "block").agg(F.min("_m").alias("_least"), F.count("*").alias("_n"))
    splits = splits.select("path", "block", "_least", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return sums.join(splits, ["path", "block"]).select("path", (F.col("_m") - F.col("_least") + F.col("_before")).alias("line"), "sum")


def gtf(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.csv(paths if isinstance(paths, str) else list(paths), sep="\t", schema=GTF, comment="#", quote="")


def gene_pred(spark: SparkSession, paths: str | Sequence[str], name: int = 1, offset: int = 1) -> DataFrame:
    """genePred rows; name and offset say where the id and the chromosome column stand."""
    f = F.split("value", "\t")
    at = {"chrom": offset + 1, "strand": offset + 2, "exon_starts": offset + 8, "exon_ends": offset + 9}
    return spark.read.text(paths if isinstance(paths, str) else list(paths)).select(f[name].alias("name"), *(f[i].alias(n) for n, i in at.items()))


def annotation_list(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Annotated junctions of four, five or more columns; without sources they belong to all."""
    return tsv(spark, paths, "chrom string, start long, end long, strand string, sources string").withColumn("sources", F.coalesce("sources", F.lit("all"))).drop("path")


def table_with_header(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A metadata table: column names in lower case with underscores, the first of equal names kept, line breaks in cells as spaces."""
    raw = spark.read.csv(path, sep=sep, header=False, multiLine=True, quote='"', escape='"')
    first = raw.first()
    names, keep = [], []
    for i, n in enumerate(first):
        n = scalars.column_name(n or f"column_{i}")
        if n not in names:
            names.append(n)
            keep.append(i)
    whole = spark.read.csv(path, sep=sep, header=True, multiLine=True, quote='"', escape='"').toDF(*(f"_c{i}" for i in range(len(first))))
    return whole.select(*(F.regexp_replace(f"_c{i}", r"[\r\n]+", " ").alias(n) for i, n in zip(keep, names, strict=True)))


def texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Whole log files with their path."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def study_cells(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Cells of the text files of studies: the folders' study_lo, study and annotation, the columns, sample and value.

    A file's header, the line after its ## lines, names the samples.
    """
    schema = "value string, study_lo string, study string, annotation string"
    lines = spark.read.schema(schema).text(path, recursiveFileLookup=False).where(~F.col("value").startswith("##"))
    by, fields, n = ["study_lo", "study", "annotation"], F.split("value", "\t"), len(columns)
    lines = lines.select(*by, fields.alias("f"))
    header = F.get("f", F.lit(0)) == columns[0]
    heads = lines.where(header).select(*by, F.slice("f", n + 1, F.size("f") - n).alias("samples")).distinct()
    rows = lines.where(~header).select(*by, *(F.get("f", F.lit(i)).alias(c) for i, c in enumerate(columns)), F.slice("f", n + 1, F.size("f") - n).alias("v"))
    return rows.join(heads, by).select(*by, *columns, F.explode(F.arrays_zip(F.col("samples").alias("s"), F.col("v").alias("v"))).alias("x")).select(*by, *columns, F.col("x.s").alias("sample"), F.col("x.v").alias("value"))


def run_statistics(spark: SparkSession, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    """Run statistics in JSON as (path, total, rule, seconds); lines where each line is a run, else a file is one."""
    schema = "total_runtime double, rules map<string, struct<`min-runtime`: double>>"
    j = spark.read.schema(schema).json(paths if isinstance(paths, str) else list(paths), multiLine=not lines)
    return j.select(F.col("_metadata.file_path").alias("path"), F.col("total_runtime").alias("total"), F.explode("rules").alias("rule", "_s")).select("path", "total", "rule", F.col("_s.min-runtime").alias("seconds"))


def manifest(files: DataFrame, path: str = "path") -> DataFrame:
    """Accession, study and their grouping characters from file paths."""
    sample, study, reference = scalars.file_parts(F.col(path))
    return files.select(path, sample.alias("accession"), study.alias("study"), reference.alias("reference"), scalars.low_order(study).alias("study_lo"), scalars.low_order(sample).alias("run_lo"))


def lowest_attempt(files: DataFrame, key: Sequence[str], path: str = "path") -> DataFrame:
    """The first finished attempt of each job."""
    tried = files.withColumn("attempt", scalars.attempt_number(F.col(path)))
    n = F.row_number().over(Window.partitionBy(*key).orderBy("attempt", path))
    return tried.withColumn("_n", n).where("_n = 1").drop("_n")
