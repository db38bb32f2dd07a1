import random

import pytest
from pyspark.sql import functions as F

from tallyweave.functions import scalars
from tallyweave.operators import annotation, checks, ids, intervals, joins, junctions, matrix, qc, ranges, rejoin
from tallyweave.plans import unify
from tallyweave.sources import frames, readers, writers


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect())


JX = "chrom string, start long, end long, name string, cov long, strand string, motif string, sample long"


def sample_rows(spark, n=200, seed=1):
    r = random.Random(seed)
    return spark.createDataFrame([(r.choice(["chr1", "chr10", "chr2"]), s := r.randrange(20), s + r.choice([5, 9]), f"n{i % 3}", r.randrange(9), r.choice("+-"), "GT-AG", i % 7) for i in range(n)], JX)


def test_first_row_gives_strand_and_order_is_that_of_text(spark):
    df = spark.createDataFrame([("c", 1, 5, "b", 9, "+", "X", 1), ("c", 1, 5, "a", 10, "-", "Y", 2), ("c", 1, 5, "a", 9, "+", "Z", 3)], JX)
    assert rows(junctions.merge_packed(df)) == [("c", 1, 5, "-", "Y", ",2:10,3:9,1:9")]
    assert {r[3:5] for r in rows(junctions.merge_long(df).select("chrom", "start", "end", "strand", "motif"))} == {("-", "Y")}


def test_hierarchical_merge_equals_flat(spark):
    df = sample_rows(spark)
    flat = matrix.packed_to_long(junctions.merge_packed(df)).drop("strand", "motif")
    parts = [junctions.merge_packed(df.where(F.col("sample") % 3 == i)) for i in range(3)]
    assert rows(matrix.packed_to_long(junctions.merge_again(parts)).drop("strand", "motif")) == rows(flat)


def test_statistics(spark):
    df = spark.createDataFrame([("c", 1, 2, v) for v in (1, 2, 4)] + [("c", 3, 4, v) for v in (1, 2)], "chrom string, start long, end long, cov long")
    assert rows(junctions.sample_statistics(df)) == [("c", 1, 2, 3, 7, 2.333, 2.0), ("c", 3, 4, 2, 3, 1.5, 1.5)]


def test_intersect_keeps_extras_in_source_order(spark):
    a = spark.createDataFrame([("c", 1, 2, "+", "x"), ("c", 3, 4, "+", "y")], "chrom string, start long, end long, strand string, e string")
    b = spark.createDataFrame([("c", 1, 2, "-", "z")], a.schema)
    assert rows(junctions.intersect([a, b], ["e"])) == [("c", 1, 2, "+", "x", "z")]


def test_annotation_ignores_strand_and_marks_either_side(spark):
    j = spark.createDataFrame([("c", 1, 9, "gt-ag"), ("c", 1, 8, "gt-ag"), ("c", 2, 9, "gt-ag"), ("d", 5, 6, "at-ac")], "chrom string, start long, end long, motif string")
    a = spark.createDataFrame([("c", 1, 9, "b,a"), ("c", 1, 9, "c"), ("c", 4, 9, None)], "chrom string, start long, end long, sources string")
    got = {(r.start, r.end): (r.annotated, r.left_motif, r.left_annotated, r.right_annotated, r.length) for r in junctions.annotate(j, a).collect()}
    assert got == {(1, 9): (1, "GT", "a,b,c", "a,all,b,c", 9), (1, 8): (0, "GT", "a,b,c", "0", 8), (2, 9): (0, "GT", "0", "a,all,b,c", 8), (5, 6): (0, "AT", "0", "0", 2)}


def test_motifs_across_chunk_borders(spark):
    r = random.Random(3)
    seq = "".join(r.choice("acgtN") for _ in range(101))
    spans = [(s, e) for s in range(1, 99) for e in (s + 1, s + 2, 100) if e <= 100 and e > s]
    j = spark.createDataFrame([("c", s, e) for s, e in spans], "chrom string, start long, end long")
    got = junctions.look_up_motifs(j, junctions.genome_chunks(spark.createDataFrame([("c", seq)], "chrom string, seq string"), 10), 10)
    assert all(r.motif == f"{seq[r.start - 1:r.start + 1]}-{seq[r.end - 2:r.end]}" for r in got.collect())


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert [r.n for r in ranges.numbered(df, ["v"], "n").orderBy("v").collect()] == list(range(1000))


def test_overlap_join_equals_double_loop(spark):
    r = random.Random(5)
    make = lambda n: [("c", s := r.randrange(500), s + r.randrange(1, 60), i) for i in range(n)]
    a, b = make(80), make(80)
    schema = "chrom string, start long, end long, id long"
    got = rows(intervals.overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 16), "id", "id_r")
    assert got == sorted((x[3], y[3]) for x in a for y in b if x[1] < y[2] and y[1] < x[2])


def test_disjoin_and_coalesce_cover_the_same_bases(spark):
    r = random.Random(7)
    iv = [("c", s := r.randrange(300), s + r.randrange(0, 20)) for _ in range(40)]
    df = spark.createDataFrame(iv, "chrom string, start long, end long")
    base = {p for _, s, e in iv for p in range(s, e + 1)}
    pieces = rows(intervals.disjoin(df))
    assert sorted(p for _, s, e in pieces for p in range(s, e + 1)) == sorted(base)
    bounds = {s for _, s, _ in iv} | {e + 1 for _, _, e in iv}
    assert all(not any(s < b <= e for b in bounds) for _, s, e in pieces)
    merged = sorted(rows(intervals.coalesce(df, 2)))
    assert all(b[1] - a[2] >= 2 for a, b in zip(merged, merged[1:], strict=False))
    assert base <= {p for _, s, e in merged for p in range(s, e + 1)}


def test_region_summary_with_overwritten_values(spark):
    values = spark.createDataFrame([("c", 0, 10, 1, 0), ("c", 5, 8, 4, 1)], "chrom string, start long, end long, value long, line long")
    flat = intervals.last_writer(values)
    regions = spark.createDataFrame([("c", 4, 12), ("c", 20, 21)], "chrom string, start long, end long")
    assert rows(intervals.summarise_regions(regions, flat, "sum")) == [("c", 4, 12, 15), ("c", 20, 21, 0)]
    assert rows(intervals.summarise_regions(regions, flat)) == [("c", 4, 12, 15 / 8), ("c", 20, 21, 0.0)]


def test_islands_and_gaps(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 5, 8, 9, 3)], "p long")
    assert [r[2] for r in rows(intervals.islands(df, "p"))] == ["1-3", "5", "8-9"]
    assert rows(intervals.gaps(df, "p")) == [(4, 4), (6, 7)]


def test_rejoin_counts_a_repeated_piece_once(spark):
    counts = spark.createDataFrame([("c", 0, 5, 1, 3, 0), ("c", 0, 5, 1, 9, 1), ("c", 5, 9, 1, 4, 2), ("c", 50, 60, 1, 4, 3)], "chrom string, start long, end long, sample long, cov long, line long")
    edges = spark.createDataFrame([("c", 0, 5, "g"), ("c", 5, 9, "g"), ("c", 0, 5, "h"), ("c", 0, 5, "h")], "chrom string, start long, end long, name string")
    key = ["chrom", "start", "end"]
    assert rows(rejoin.rejoin(counts, edges, key, ["name"], order=["line"])) == [("g", 1, 7), ("h", 1, 3)]
    assert rejoin.unmapped(counts, edges, key).count() == 1
    assert rows(junctions.repeats_of(counts, [*key, "sample"], ["line"]), "line") == [(1,)]


def test_genes_masks_and_order(spark):
    genes = spark.createDataFrame([("c", 4, 9, "g1.A1;g2.B2"), ("c", 0, 9, "g1.A1"), ("d", 0, 2, "ERCC-1"), ("d", 0, 2, "zz")], "chrom string, start long, end long, name string")
    assert rows(rejoin.genes_by_annotation(genes, ["A1", "B2"]), "gene_id", "annotation", "start") == [("ERCC-1", "ERCC", 1), ("g1", "A1", 1), ("g2", "B2", 5)]
    order = spark.createDataFrame([("b", 1), ("a", 2), ("z", 3)], "k string, o int")
    ordered, extra, missing = rejoin.in_order(spark.createDataFrame([("a",), ("b",), ("q",)], "k string"), order, "k", "o")
    assert [r.k for r in ordered.collect()] == ["b", "a"] and rows(extra, "k") == [("q",)] and rows(missing, "k") == [("z",)]
    assert rejoin.replicate(spark.createDataFrame([(0,), (2,), (-1,)], "m int"), "m").count() == 2


def test_exon_makeup(spark):
    e = "gene_id string, start long, end long"
    old = rejoin.exon_makeup(spark.createDataFrame([("g", 1, 2), ("h", 1, 2)], e))
    new = rejoin.exon_makeup(spark.createDataFrame([("g", 1, 2), ("g", 5, 6), ("h", 1, 2)], e))
    assert rows(rejoin.differing_makeup(old, new, ["gene_id"]), "gene_id", "contained") == [("g", True)]


def test_ids_go_on_from_saved_counters(spark):
    s = spark.createDataFrame([("SRR000123", 0), ("SRR999123", 1), ("sampleAB", 2)], "accession string, i long")
    one = ids.assign(s, 1, "i")
    bits = lambda p, c: int(f"{1:08b}{p}{c:b}", 2)
    letters = "".join(format(ord(c), "b")[1:].zfill(6) for c in "AB")
    assert rows(one, "accession", "rail_id") == [("SRR000123", bits("000100100011", 0)), ("SRR999123", bits("000100100011", 1)), ("sampleAB", bits(letters, 0))]
    state = ids.next_counters(one)
    two = ids.assign(spark.createDataFrame([("ERR555123", 0)], s.schema), 1, "i", state)
    assert rows(two, "counter") == [(2,)] and ids.clashes(one.unionByName(two)).count() == 0
    assert dict(rows(ids.next_counters(two, state)))["000100100011"] == 3


def test_joins(spark):
    small = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    large = spark.createDataFrame([("a", "x", "9"), ("a", "y", "9"), ("c", "z", "9")], "k string, w string, v string")
    assert rows(joins.padded_join(small, large, "k")) == [("a", "1", "x"), ("a", "1", "y"), ("b", "2", ""), ("c", "", "z")]
    assert rows(joins.padded_join(small, large, "k", "left")) == [("a", "1", "x"), ("a", "1", "y"), ("b", "2", "")]
    with pytest.raises(ValueError):
        joins.must_match(small, large, ["k"])
    text = spark.createDataFrame([("p q",), ("Q r",), ("s",)], "t string")
    words = spark.createDataFrame([("q",), ("q",)], "w string")
    assert rows(joins.filter_by(text, "t", words, "w", " ")) == [("p q",)]
    assert rows(joins.filter_by(text, "t", words, "w", " ", ignore_case=True)) == [("Q r",), ("p q",)]
    assert rows(joins.filter_by(text, "t", words, "w", " ", exclude=True)) == [("Q r",), ("s",)]
    assert rows(joins.filter_by(text, "t", words, "w", " ", repeat=True)) == [("p q",), ("p q",)]
    assert rows(joins.filter_by(text, "t", words, "w", " ", field=1)) == [("p q",)]


def test_sparse_matrix_text(spark, tmp_path):
    long = spark.createDataFrame([("r1", 20, 3), ("r1", 5, 1), ("r2", 20, 4)], "r string, s long, v long")
    triples, r, c = matrix.sparse(long, ["r"], "s", "v")
    assert rows(triples) == [(1, 1, 1), (1, 2, 3), (2, 2, 4)]
    assert checks.sparse_matrix(triples, r, c).first().ok
    frames.matrix_market(triples, str(tmp_path / "mm"), " made here")
    text = "".join(p.read_text() for p in sorted((tmp_path / "mm").glob("part-*")))
    assert text == "%%MatrixMarket matrix coordinate integer general\n% made here\n2\t2\t3\n1\t1\t1\n1\t2\t3\n2\t2\t4\n"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("st01", "A", "c", 1, 2), ("st01", "B", "c", 5, None)], "study string, annotation string, chrom string, start long, v long")
    writers.split_by(df, str(tmp_path / "s"))
    assert (tmp_path / "s/study_lo=01/study=st01/annotation=A").is_dir()
    writers.range_sorted(df, str(tmp_path / "r"))
    writers.with_preamble(df.select("chrom", "v"), str(tmp_path / "p"), ["annotation=A"])
    assert [x.value for x in spark.read.text(str(tmp_path / "p")).collect()][:2] == ["##annotation=A", "chrom\tv"]
    writers.compressed_tsv(df, str(tmp_path / "t"))
    assert spark.read.csv(str(tmp_path / "t"), sep="\t").count() == 2 and spark.read.parquet(str(tmp_path / "r")).count() == 2


def test_readers(spark, tmp_path):
    import zstandard

    (tmp_path / "a.bed").write_text("chrom\tstart\tend\tname\tscore\tstrand\tsplice_site\nc\t1\t5\tn\t3\t+\tGT-AG\nc\tx\t5\tn\t3\t+\tGT\nc\t1\n")
    assert rows(readers.junction_bed(spark, str(tmp_path / "a.bed")), "chrom", "start", "cov") == [("c", 1, "3")]
    (tmp_path / "x.zst").write_bytes(zstandard.compress(b"c\t1\t2\nd\t3\t4\n"))
    assert rows(readers.zstd_tsv(spark, str(tmp_path / "x.zst"), ["chrom", "start", "end"]), "chrom", "end") == [("c", "2"), ("d", "4")]
    (tmp_path / "m.tsv").write_text('Study ID\tSample\tsample\n"s\n1"\ta\tb\n')
    assert rows(readers.table_with_header(spark, str(tmp_path / "m.tsv"))) == [("s 1", "a")]
    (tmp_path / "j.json").write_text('{"total_runtime": 9.5, "rules": {"a": {"min-runtime": 2.0}, "b": {"min-runtime": 3.0}}}')
    assert rows(readers.run_statistics(spark, str(tmp_path / "j.json")), "total", "rule", "seconds") == [(9.5, "a", 2.0), (9.5, "b", 3.0)]
    (tmp_path / "x.gtf").write_text('c\ts\texon\t1\t10\t.\t+\t.\tgene_id "g"; transcript_id "t"; tag "1"; tag "2";\nc\ts\texon\t12\t20\t.\t+\t.\tgene_id "g"; transcript_id "t";\nc\ts\texon\t30\t40\t.\t+\t.\tgene_id "g"; transcript_id "t";\n')
    gtf = readers.gtf(spark, str(tmp_path / "x.gtf"))
    assert rows(annotation.introns_of_gtf(gtf)) == [("c", 11, 11, "+", ["t"]), ("c", 21, 29, "+", ["t"])]
    assert annotation.gtf_statistics(annotation.exons_of_gtf(gtf)).first().genes == 1
    (tmp_path / "k.txt").write_text("0\tnm\tchr1\t+\t0\t9\t0\t9\t2\t0,20,\t10,30,\n")
    assert rows(annotation.introns_of_gene_pred(readers.gene_pred(spark, str(tmp_path / "k.txt")))) == [("chr1", 11, 20, "+", "nm")]


def test_metrics_and_ratios(spark):
    logs = spark.createDataFrame([("s", "Mapped: 7\nMapped: 9\nLen: 3")], "sample string, text string")
    long = qc.metrics(logs, {"mapped": r"Mapped: (\d+)", "len": r"Len: (\d+)"})
    assert rows(long) == [("s", "len", "3"), ("s", "mapped", "7"), ("s", "mapped2", "9")]
    wide = qc.table(long, ["sample"], ["mapped", "mapped2", "len"])
    assert wide.columns == ["sample", "len", "mapped", "mapped2"]
    both = qc.both_ends(wide.select("sample", *(F.col(c).cast("long").alias(c) for c in wide.columns[1:])), ["mapped"], "len").first()
    assert both.mapped_both == 16 and both.mapped_both_percent == 533.3
    idx = spark.createDataFrame([("s", "chrM", 1), ("s", "chr1", 3), ("t", "chr1", 0)], "sample string, chrom string, mapped long")
    assert rows(qc.chromosome_shares(idx, ["sample"]), "sample", "chrM_percent") == [("s", 25.0), ("t", -1.0)]


def test_scalars(spark):
    df = spark.createDataFrame([("1e+05", "12.75", "SRR12", "001012000")], "c string, d string, a string, m string")
    r = df.select(scalars.count_value(F.col("c")).alias("c"), scalars.strip_decimals(F.col("d")).alias("d"), scalars.low_order(F.col("a")).alias("l"), scalars.mask_counts(F.col("m")).alias("m"), scalars.trim_decorations(F.lit("TCGA_x.tar.gz"), ["TCGA", ".tar.gz"]).alias("t"), scalars.one_based_key(F.lit("c"), F.lit(4), F.lit(9), F.lit("+")).alias("k")).first()
    assert tuple(r) == (100000, "12", "12", [1, 12, 0], "_x", "c|5|9|+")
    assert scalars.check_project("sra:101") == ("sra", 101)
    for bad in ("sra:99", "sra:250", "sra", ":101"):
        with pytest.raises(ValueError):
            scalars.check_project(bad)


def test_lift(spark):
    j = spark.createDataFrame([("c", 11, 20, 1), ("c", 95, 120, 2)], "chrom string, start long, end long, id long")
    chain = spark.createDataFrame([("c", 0, 100, "k", 1000)], "chrom string, start long, end long, to_chrom string, offset long")
    moved, lost = annotation.lift(j, chain)
    assert rows(moved) == [("k", 1011, 1020, 1)] and rows(lost, "id") == [(2,)]


def test_plans(spark):
    raw = spark.createDataFrame([("c", 3, 6, 1, 0, 0, 2, 1, 9, 1, 0), ("c", 3, 6, 1, 0, 0, 5, 1, 9, 1, 1), ("c", 3, 6, 2, 0, 0, 4, 0, 9, 2, 0)], "chrom string, start long, end long, strand int, motif int, annotated int, num_uniques long, num_multis long, max_overhang long, sample long, line long")
    chunks = junctions.genome_chunks(spark.createDataFrame([("c", "aaGTAGcc")], "chrom string, seq string"))
    ann = spark.createDataFrame([("c", 3, 6, "x")], "chrom string, start long, end long, sources string")
    r = unify.junction_tables(raw, ann, chunks).first()
    assert (r.motif, r.annotated, r["count"], r["sum"], r.junction_id) == ("GT-AG", 1, 2, 7, 0)


def test_gtf_ids_are_found_in_one_pass(spark):
    r = random.Random(5)
    bits = ['gene_id "G1";', 'transcript_id "T1";', "gene_id", ' "', '"', "; ", 'note "gene_id "', 'my.gene_id "x"', 'xgene_id "no"', 'gene_id ""', "\n", "é ", 'gene_id  "two"', 'transcript_id "a\nb"', "k 7;"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(9))) for _ in range(600)] + [None, 'gene_id "G', 'note "' + "x y; " * 30_000 + '"; transcript_id "far"; gene_id "G2"']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for key in ("gene_id", "transcript_id"):
        got = F.nullif(scalars.gtf_attribute(F.col("t"), key), F.lit(""))
        want = F.concat(F.lit('"'), scalars.gtf_attributes(F.col("t"))[key])
        assert df.where(~got.eqNullSafe(want)).collect() == []


def test_gtf_statistics_read_and_shuffle_exons_once(spark):
    exons = [("c", 5 * i % 90, 5 * i % 90 + i % 4, "+", f"g{i % 3}", f"t{i % 7}") for i in range(60)] + [("d", 1, 3, "-", "g0", "t0")]
    df = spark.createDataFrame(exons, "chrom string, start long, end long, strand string, gene string, transcript string")
    stats = annotation.gtf_statistics(df)
    length = lambda x: x[2] - x[1] + 1
    per, gaps = {}, []
    for x in exons:
        per.setdefault(x[4:], []).append(length(x))
    for t in {x[5] for x in exons}:
        own = sorted(x[1:3] for x in exons if x[5] == t)
        gaps += [b[0] - a[1] - 1 for a, b in zip(own, own[1:], strict=False) if b[0] - 1 >= a[1] + 1]
    mean = lambda v: sum(v) / len(v)
    want = (3, 7, mean([*map(length, exons)]), mean(gaps), mean([sum(v) for v in per.values()]), mean([len(v) for v in per.values()]))
    assert tuple(stats.first()) == pytest.approx(want)
    assert tuple(annotation.gtf_statistics(df.limit(0)).first()) == (0, 0, None, None, None, None)
    plan = stats._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ExistingRDD") == 1 and plan.count("Window") == 1


def test_transcripts_exons_merge_where_they_meet(spark):
    r = random.Random(3)
    exons = [(r.choice("cd"), s, s + r.choice([0, 1, 7, 40]), r.choice("+-"), f"g{i % 2}", r.choice(["t0", "t1", "t2", None])) for i in range(400) for s in [r.randrange(1, 1500)]] + [("c", None, 4, "+", "g", "t0"), ("c", 4, None, "+", "g", "t0")]
    df = spark.createDataFrame(exons, "chrom string, start int, end int, strand string, gene string, transcript string")
    names = ("transcript", "chrom", "strand", "start", "end")
    for gap in (1, 2, 30):
        merged = annotation.merged_exons(df, gap)
        assert sorted(map(str, (tuple(x[c] for c in names) for x in merged.collect()))) == sorted(map(str, (tuple(x[c] for c in names) for x in intervals.coalesce(df, gap, names[:3]).collect())))
    gtf = df.select("chrom", F.lit("exon").alias("feature"), "start", "end", "strand", F.format_string('gene_id "%s"; transcript_id "%s";', "gene", "transcript").alias("attributes"))
    plan = annotation.introns_of_gtf(gtf)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 2 and plan.count("ExistingRDD") == 1  # by transcript, then by intron
