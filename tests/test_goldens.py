"""Small worked examples with known results, given as they are (fixed values)."""

import pytest

from tallyweave.operators import annotation, intervals, joins, junctions, matrix, qc, rejoin
from tallyweave.functions import scalars
from tallyweave.sources import readers, writers
from pyspark.sql import functions as F

JUNCTIONS = {
    0: ["chr1 14829 14970 A1 55 + CT-AC", "chr1 15038 15796 A3 25 + CT-AC", "chr1 16765 16858 A7 7 - GT-AG", "chr2 15829 16970 C5 55 + CT-AC", "chr2 16829 18970 A5 55 + CT-AC", "chr3 10829 11970 A6 55 + CT-AC"],
    1: ["chr1 14930 14970 B1 55 + CT-AC", "chr1 16765 16858 B7 7 - GT-AG", "chr1 1304000 1379600 B3 25 + CT-AC", "chr1_Un 16765 16858 A7 7 - GT-AG", "chr2 15829 16970 B5 55 + CT-AC", "chr3 11829 12970 B6 55 + CT-AC"],
    2: ["chr1 14968 15970 C1 55 + CT-AC", "chr1 16968 17970 C2 55 + CT-AC", "chr2 15829 16970 C5 55 + CT-AC", "chr3 13829 14970 C6 55 + CT-AC"],
}
MERGED = """chr1 14829 14970 + CT-AC ,0:55
chr1 14930 14970 + CT-AC ,1:55
chr1 14968 15970 + CT-AC ,2:55
chr1 15038 15796 + CT-AC ,0:25
chr1 16765 16858 - GT-AG ,0:7,1:7
chr1 16968 17970 + CT-AC ,2:55
chr1 1304000 1379600 + CT-AC ,1:25
chr1_Un 16765 16858 - GT-AG ,1:7
chr2 15829 16970 + CT-AC ,1:55,0:55,2:55
chr2 16829 18970 + CT-AC ,0:55
chr3 10829 11970 + CT-AC ,0:55
chr3 11829 12970 + CT-AC ,1:55
chr3 13829 14970 + CT-AC ,2:55"""


def test_merge_of_three_files(spark, tmp_path):
    head = "chrom\tstart\tend\tname\tscore\tstrand\tsplice_site\n"
    for sample, lines in JUNCTIONS.items():
        (tmp_path / f"s{sample}.jx_bed").write_text(head + "".join(x.replace(" ", "\t") + "\n" for x in lines))
    manifest = spark.createDataFrame([(f"{tmp_path}/s{i}.jx_bed", i) for i in JUNCTIONS], "file string, sample long")
    rows = readers.with_samples(readers.junction_bed(spark, str(tmp_path)), manifest).withColumn("cov", F.col("cov").cast("long"))
    got = junctions.merge_packed(rows).orderBy("chrom", "start", "end").collect()
    assert [" ".join(map(str, r)) for r in got] == MERGED.splitlines()


PIECES = [(11868, 11873), (11873, 12009), (12009, 12057), (12009, 12057), (12057, 12178), (12178, 12227), (12612, 12697), (12697, 12721)]
COUNTS = [[0, 0, 0, 0, 0, 5, 0, 0, 0, 0, 0, 0], [0, 0, 0, 45, 0, 91, 0, 0, 58, 0, 0, 0], [0, 0, 0, 144, 0, 0, 0, 0, 48, 0, 0, 0], [0, 0, 0, 144, 0, 0, 0, 0, 48, 0, 0, 0], [0, 0, 0, 428, 0, 0, 0, 0, 42, 0, 0, 0], [0, 0, 0, 6, 0, 0, 0, 0, 0, 0, 0, 0], [0, 0, 0, 170, 0, 0, 0, 0, 0, 85, 0, 0], [0, 0, 0, 48, 0, 0, 0, 0, 0, 24, 0, 0]]
G = ("ENSG00000223972.5.G026", "ENSG00000223972.5.G029")
FEATURES = {(11868, 12227): (G, [0, 1, 2, 4, 5]), (11873, 12227): (("gene0.R109",), [1, 2, 4, 5]), (12009, 12057): (G, [2]), (12178, 12227): (G, [5]), (12612, 12697): (G, [6]), (12612, 12721): ((*G, "gene0.R109"), [6, 7])}
REJOINED = {
    (11868, 12227): (359, [0, 0, 0, 623, 0, 96, 0, 0, 148, 0, 0, 0]), (12009, 12057): (48, [0, 0, 0, 144, 0, 0, 0, 0, 48, 0, 0, 0]), (12178, 12227): (49, [0, 0, 0, 6, 0, 0, 0, 0, 0, 0, 0, 0]),
    (12612, 12697): (85, [0, 0, 0, 170, 0, 0, 0, 0, 0, 85, 0, 0]), (11873, 12227): (354, [0, 0, 0, 623, 0, 91, 0, 0, 148, 0, 0, 0]), (12612, 12721): (109, [0, 0, 0, 218, 0, 0, 0, 0, 0, 109, 0, 0]),
}


def test_rejoin_of_a_gene(spark):
    """Disjoint pieces of which one is listed twice, carried back to six features."""
    counts = spark.createDataFrame([(*PIECES[i], s, c, i) for i, row in enumerate(COUNTS) for s, c in enumerate(row)], "start long, end long, sample long, cov long, line long")
    edges = spark.createDataFrame([(*PIECES[i], *f, n) for f, (names, pieces) in FEATURES.items() for n in names for i in pieces], "start long, end long, f_start long, f_end long, name string")
    sums = {}
    for r in rejoin.rejoin(counts, edges, ["start", "end"], ["f_start", "f_end"], order=["line"]).collect():
        sums.setdefault((r.f_start, r.f_end), {})[r.sample] = r["cov"]
    lengths = {(r.f_start, r.f_end): (r.bp_length, r.names) for r in rejoin.feature_lengths(edges, ["f_start", "f_end"], "name").collect()}
    assert {f: (lengths[f][0], [sums[f][s] for s in range(12)]) for f in sums} == REJOINED
    assert lengths[12612, 12721][1] == ";".join((*G, "gene0.R109"))
    repeats = junctions.repeats_of(counts, ["start", "end", "sample"], ["line"]).select("start", "line").distinct().collect()
    assert [tuple(r) for r in repeats] == [(12009, 3)]


SPANS = "chr1 1 5,chr1 3 7,chr1 4 8,chr2 10 15,chr2 10 20,chr2 17 30,chr3 50 60,chr3 60 70,chr3 65 67,chr4 100 110,chr4 105 110,chr5 200 205,chr6 300 300"
DISJOINT = "chr1 1 2,chr1 3 3,chr1 4 5,chr1 6 7,chr1 8 8,chr2 10 15,chr2 16 16,chr2 17 20,chr2 21 30,chr3 50 59,chr3 60 60,chr3 61 64,chr3 65 67,chr3 68 70,chr4 100 104,chr4 105 110,chr5 200 205,chr6 300 300"


def test_disjoin(spark):
    read = lambda text: [(c, int(s), int(e)) for c, s, e in (x.split() for x in text.split(","))]
    got = intervals.disjoin(spark.createDataFrame(read(SPANS), "chrom string, start long, end long")).select("chrom", "start", "end").collect()
    assert sorted(map(tuple, got)) == read(DISJOINT)


def test_long_and_short_intervals_meet_once(spark):
    import random

    r = random.Random(2)
    make = lambda n: [("c", s := r.randrange(100_000), s + r.choice([1, 30, 700, 40_000, 90_000]), i) for i in range(n)]
    a, b = make(120), make(90)
    schema = "chrom string, start long, end long, id long"
    got = intervals.overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 16).select("id", "id_r").collect()
    assert sorted(map(tuple, got)) == sorted((x[3], y[3]) for x in a for y in b if x[1] < y[2] and y[1] < x[2])


def test_fasta_chunks_across_lines_and_files(spark, tmp_path):
    import random

    r = random.Random(4)
    genome = {f"chr{i}": "".join(r.choice("acgtN") for _ in range(n)) for i, n in enumerate((1, 9, 10, 11, 205, 3000))}
    for f, names in (("a.fa", list(genome)[:4]), ("b.fa", list(genome)[4:])):
        (tmp_path / f).write_text("".join(f">{n} some text\n" + "\n".join(genome[n][i : i + 7] for i in range(0, len(genome[n]), 7)) + "\n" for n in names) + ">empty\n")
    chunks = readers.fasta_chunks(spark, str(tmp_path), 10)
    got = {}
    for c in chunks.collect():
        got.setdefault(c.chrom, {})[c.chunk] = c.seq
    assert got == {n: {k: s[k * 10 : k * 10 + 11] for k in range((len(s) - 1) // 10 + 1)} for n, s in genome.items()}
    assert {r.chrom: r.size for r in readers.chromosome_sizes(chunks, 10).collect()} == {n: len(s) for n, s in genome.items()}


def test_unknown_chromosomes_and_text_ids(spark):
    chunks = spark.createDataFrame([("c", 0, "ACGTACGT")], "chrom string, chunk int, seq string")
    j = spark.createDataFrame([("c", 1, 4), ("c", 5, 9), ("d", 1, 4)], "chrom string, start long, end long")
    assert {(r.chrom, r.end): r.motif for r in junctions.look_up_motifs(j, chunks).collect()} == {("c", 4): "AC-GT", ("c", 9): None, ("d", 4): None}
    assert [tuple(r) for r in junctions.look_up_motifs(j, chunks, unknown=False).collect()] == [("c", 1, 4, "AC-GT")]
    packed = spark.createDataFrame([(1, ",SRR1:5,SRR2:7")], "k int, samples string")
    assert sorted(map(tuple, matrix.packed_to_long(packed).collect())) == [(1, "SRR1", 5), (1, "SRR2", 7)]


def test_filters_beyond_any_list_length(spark, monkeypatch):
    rows = spark.createDataFrame([("a b",), ("c",), ("d a",), ("a b",), (None,)], "t string")
    words = spark.createDataFrame([("a",), ("z",), ("a",)], "w string")
    want = {False: ["a b", "a b", "d a"], True: ["None", "c"]}
    for most in (10, 1):
        monkeypatch.setattr(joins, "WORDS", most)
        for exclude in want:
            assert sorted(str(r.t) for r in joins.filter_by(rows, "t", words, "w", " ", exclude=exclude).collect()) == want[exclude]
    assert sorted(r.t for r in joins.filter_by(rows, "t", words, "w", " ", repeat=True).collect()) == ["a b"] * 4 + ["d a"] * 2
    patterns = spark.createDataFrame([("^a",), ("^c",), ("x",), (None,)], "p string")
    assert sorted(r.t for r in joins.filter_by_patterns(rows, "t", patterns, "p", most=1).collect()) == ["a b", "a b", "c"]


def test_guards_and_strictness(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    new = spark.createDataFrame([("a", 5)], old.schema)
    assert rejoin.guarded_update(old, new, "k", ["v"], ["b"]).count() == 2
    with pytest.raises(ValueError, match="must not change"):
        rejoin.guarded_update(old, new, "k", ["v"], ["a"])
    counts = spark.createDataFrame([(1, 1, 3), (2, 1, 4)], "p long, sample long, cov long")
    edges = spark.createDataFrame([(1, "g")], "p long, f string")
    with pytest.raises(ValueError, match="without a feature"):
        rejoin.rejoin(counts, edges, ["p"], ["f"], strict=True)
    with pytest.raises(ValueError, match="without a name"):
        matrix.renamed_columns(spark.createDataFrame([(1, 2)], "`7` long, x long"), spark.createDataFrame([(8, "n")], "rail_id long, accession string"))


def test_release_codes_follow_the_rule(spark):
    codes = annotation.source_codes(33, 24)
    assert codes["hg19/gencode.v3.annotation.gtf.gz"] == "gC03" and codes["hg38/gencode.v33.annotation.gtf.gz"] == "gC33" and codes["m38/gencode.vM24.annotation.gtf.gz"] == "gC24"
    assert codes["hg38/knownGene.txt.gz"] == "kG38" and codes["m37/refGene.txt.gz"] == "rG37" and codes["hg38/chess2.2_assembly.gtf.gz"] == "cH38"
    row = spark.createDataFrame([("TCGA-AB-1.tar.gz", "SRR12345")], "a string, b string").select(scalars.leading_bits(F.col("a"), decorations=[".tar.gz", "TCGA"]).alias("a"), scalars.leading_bits(F.col("b")).alias("b")).first()
    assert row.a == "".join(format(ord(c), "b")[1:].zfill(6) for c in "AB") and row.b == "000100100011"


def test_report_of_logs(spark):
    star = "  Number of input reads |\t100\n  Uniquely mapped reads number |\t60\n  Number of reads mapped to multiple loci |\t20\n  Uniquely mapped reads number |\t6\n"
    logs = lambda text: spark.createDataFrame([("s", "r", text)], "study string, sample string, text string")
    long = qc.log_lines(logs(star), "star").unionByName(qc.log_lines(logs("chrX\t9\t30\t0\nchr1\t9\t70\t0\n*\t0\t0\t5"), "idxstats")).unionByName(qc.counter_lines(logs("|| Total alignments : 80 ||\n|| Successfully assigned alignments : 40 (50%) ||"), "gene_fc_count_all"))
    assert {r.key: r.value for r in long.where("key like 'star%'").collect()}["star.Uniquely_mapped_reads_number2"] == 6
    r = qc.report(long).first()
    assert (r["star.All_mapped_reads"], r["gene_fc.all_percent"], r["idxstats.chrX_percent"], r["idxstats.chrM_percent"], r["bc_auc.all_percent"]) == (80, 50, 30, -1, 0)


def test_bucketed_table(spark):
    rows = spark.range(100).selectExpr("id", "id % 7 k")
    try:
        writers.table(rows, "bucketed_rows", ["k"], 3)
        assert spark.table("bucketed_rows").count() == 100
    finally:
        spark.sql("drop table if exists bucketed_rows")
