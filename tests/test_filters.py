import random

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import annotation, checks, joins, qc


def texts(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id long, t string")


def kept(df):
    return sorted(r.id for r in df.collect())


def test_a_hundred_thousand_words(spark, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK_ROWS", 20)
    r = random.Random(1)
    words = spark.range(100_000).select(F.concat(F.lit("w"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("!")).alias("w"))
    rows = [f"{r.random()} w{r.randrange(200_000):06d}! {r.random()}" for _ in range(60)] + [None, "", "w00000", "W000001!"]
    want = [i for i, t in enumerate(rows) if t and "w" in t and any(t[k : k + 8][-1:] == "!" and t[k + 1 : k + 7].isdigit() and int(t[k + 1 : k + 7]) < 100_000 for k in range(len(t)) if t[k] == "w")]
    df = texts(spark, rows)
    assert kept(joins.filter_by_literals(df, "t", words, "w")) == want
    assert kept(joins.filter_by_literals(df, "t", words, "w", exclude=True)) == [i for i in range(len(rows)) if i not in want]
    assert kept(joins.filter_by_literals(df, "t", words, "w", ignore_case=True)) == sorted({*want, len(rows) - 1})


@pytest.mark.parametrize("most", [2, 1000])
def test_literals_and_patterns_in_one_or_many_parts(spark, most):
    df = texts(spark, ["ab.c", "abxc", "x(y", None, "", "zz"])
    words = spark.createDataFrame([("b.c",), ("(y",), ("q",), (None,), ("nothing",)], "w string")
    assert kept(joins.filter_by_literals(df, "t", words, "w", most=most)) == [0, 2]
    assert kept(joins.filter_by_patterns(df, "t", words.where("w <> '(y'"), "w", most=most)) == [0, 1]
    assert kept(joins.filter_by_patterns(df, "t", words.where("w <> '(y'"), "w", exclude=True, most=most)) == [2, 3, 4, 5]
    assert kept(joins.filter_by_literals(df, "t", words.unionByName(spark.createDataFrame([("",)], "w string")), "w", most=most)) == [0, 1, 2, 4, 5]
    none = words.where("w is null")
    assert kept(joins.filter_by_literals(df, "t", none, "w")) == [] and kept(joins.filter_by_patterns(df, "t", none, "w", exclude=True)) == list(range(6))


def test_many_plain_patterns_are_joined_by_equality(spark, monkeypatch):
    tails = [f"0{i}$" for i in range(40)]
    others = ["^ab", r"^x\.y$", "^$", r"a\$b", "mid", r"z+\d$", "end\r$", "é$", r"\w\b!", "(?i)q7$", r"\n$", "^😀u", "[", ""]
    rows = ["c007", "c07\n", "c07\r\n", "c07\n\n", "c07 ", "abc", "xab", "x.y", "xzy", "x.y\n", "", "\n", "\r\n", "1a$b2", "amidst", "zz5", "zz5x", "end\r\n", "end\r", "caf\u00e9\u2028", "a!", "Q7", "\U0001f600u", "\u2028x", None, "039", "0390", "00"]
    df = texts(spark, rows)
    given = spark.createDataFrame([(p,) for p in tails + others if p not in ("", "[")], "w string")
    want = kept(joins.filter_by_patterns(df, "t", given, "w"))  # one expression
    seen = []
    monkeypatch.setattr(joins, "_cells", lambda r, c, p, n, made=joins._cells: seen.append(sorted(x._w for x in p.collect())) or made(r, c, p, n))
    assert kept(joins.filter_by_patterns(df, "t", given, "w", most=3)) == want
    assert kept(joins.filter_by_patterns(df, "t", given, "w", exclude=True, most=3)) == [i for i in range(len(rows)) if i not in want]
    assert seen == [sorted([r"z+\d$", r"\w\b!", "(?i)q7$", r"\n$"])] * 2  # only these meet every row
    loose = spark.range(10_001).select(F.concat(F.lit("mid"), "id").alias("w")).unionByName(spark.createDataFrame([("mids",)], "w string"))
    assert kept(joins.filter_by_patterns(df, "t", loose, "w")) == [14]
    for p in ("", "^", "^$"):
        one = spark.createDataFrame([(p,), *((f"nowhere{i}$",) for i in range(5))], "w string")
        assert kept(joins.filter_by_patterns(df, "t", one, "w", most=3)) == kept(joins.filter_by_patterns(df, "t", one, "w"))


def test_junctions_over_two_blocks_and_minus_strands(spark):
    j = spark.createDataFrame([("c", 11, 120, "+", 1), ("c", 11, 95, "-", 2), ("c", 11, 150, "+", 3), ("d", 11, 20, "?", 4), ("c", 11, 120, "+", 1)], "chrom string, start long, end long, strand string, id long")
    blocks = [(7, 10, "c", 0, 50, "k", 1000, "+", 100), (7, 10, "c", 100, 130, "k", 1000, "+", 170), (8, 99, "c", 0, 50, "m", 500, "-", 20), (8, 99, "c", 80, 100, "m", 500, "-", 90), (9, 99, "c", 140, 160, "n", 500, "+", 0), (5, 10, "c", 0, 200, "z", 900, "+", 0), (4, 10, "c", 0, 130, "y", 900, "+", 5)]
    chains = spark.createDataFrame(blocks, "chain int, score int, chrom string, start long, end long, to_chrom string, to_size long, to_strand string, to_start long")
    moved, lost = annotation.lift_ends(j, chains)
    # base 10 goes to 20 + 10 from the end of m, 499 - 30 = 469; base 94 to 90 + 14, 499 - 104 = 395
    assert sorted(map(tuple, moved.collect())) == [("m", 396, 470, "+", 2), ("y", 16, 125, "+", 1), ("z", 11, 150, "+", 3)]
    assert sorted(map(tuple, lost.collect())) == [("d", 11, 20, "?", 4)]
    moved, _ = annotation.lift_ends(j.where("id = 1"), chains.where("chain = 7"))
    assert [tuple(r) for r in moved.collect()] == [("k", 111, 190, "+", 1)]


@pytest.mark.parametrize("longest", [30, 4000])
def test_junctions_are_lifted_in_one_shuffle(spark, longest):
    r = random.Random(longest)
    blocks = [(k, k % 3, "cd"[k % 2], s, s + n, f"t{k}", 9000, "+-"[k % 5 == 0], s + 7 * k) for k in range(12) for s in [r.randrange(-50, 4000) for _ in range(40 if longest < 99 else 4)] for n in [r.randrange(longest)]]
    chains = spark.createDataFrame(blocks, "chain int, score int, chrom string, start long, end long, to_chrom string, to_size long, to_strand string, to_start long")
    spans = [(i % 40, r.choice("cde"), s, s + r.choice([-9, 0, 5, 60, 900]), r.choice("+-?")) for i in range(300) for s in [r.randrange(-20, 4000)]] + [(1, "c", None, 5, "+"), (2, None, 1, 5, "+")]
    j = spark.createDataFrame(spans + spans[:9], "id int, chrom string, start long, end long, strand string")
    want, lost = [], []
    for id, chrom, start, end, strand in set(spans):
        found = {}
        for k, score, c, s, e, to, size, sign, t in blocks:
            for side, pos in enumerate((start, end)):
                if pos is not None and c == chrom and s <= pos - 1 < e:
                    x = t + pos - 1 - s
                    found.setdefault((score, -k), []).append((side, size - 1 - x if sign == "-" else x, to, sign))
        whole = {key: v for key, v in found.items() if {x[0] for x in v} == {0, 1}}
        if whole and start is not None:
            v = whole[max(whole)]
            turned = strand.translate(str.maketrans("+-", "-+")) if v[0][3] == "-" else strand
            want.append((id, v[0][2], min(x[1] for x in v) + 1, max(x[1] for x in v) + 1, turned))
        else:
            lost.append((id, chrom, start, end, strand))
    order = lambda rows: sorted(map(tuple, rows), key=str)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved, rest = annotation.lift_ends(j, chains, 16)
        assert len(want) > 30 and order(moved.collect()) == order(want) and order(rest.collect()) == order(lost)
        plan = moved._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert plan.count("Exchange hashpartitioning") <= 3  # the rows, and the blocks for either end
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_figures_of_the_write_itself(spark, tmp_path):
    t = spark.createDataFrame([(1, 1, 5), (2, 3, 7), (4, 3, None)], "row_idx int, col_idx int, value int")
    got = checks.matrix_written(t, str(tmp_path / "a"), 4, 3)
    assert (got["entries"], got["blanks"], got["last_row"], got["ok"]) == (3, 1, 4, False)
    assert checks.matrix_written(t.where("value > 0"), str(tmp_path / "b"), 4, 3, 2)["ok"]
    assert not checks.matrix_written(t.where("value > 0"), str(tmp_path / "c"), 1, 3)["ok"]
    assert not checks.matrix_written(t.where("value > 0"), str(tmp_path / "d"), 4, 4)["ok"]
    assert not checks.matrix_written(t.where("value > 0"), str(tmp_path / "e"), 4, 3, 9)["ok"]
    assert spark.read.parquet(str(tmp_path / "a")).count() == 3


def test_log_lines_of_each_kind(spark):
    log = lambda text: spark.createDataFrame([("s", text)], "sample string, text string")
    star = "                 Started job on |\tDec 10 11:00:00\n   Number of input reads |\t1200\n   UNIQUE READS:\n   Uniquely mapped reads % |\t85.12%\n   Number of input reads |\t7"
    assert sorted((r.key, r.value) for r in qc.log_lines(log(star), "star").collect()) == [("star.Number_of_input_reads", 1200.0), ("star.Number_of_input_reads2", 7.0), ("star.Uniquely_mapped_reads_%", 85.12)]
    assert [(r.key, r.value) for r in qc.log_lines(log("chrM\t16569\t40\t0\n*\t0\t0\t9"), "idxstats").collect()] == [("idxstats.chrM", 40.0)]
    assert [(r.key, r.value) for r in qc.log_lines(log("STAT\tKALLISTO_MEAN\t20.5\nSTAT\tx\ny\n7\t3"), "bc_frag").collect()] == [("bc_frag.KALLISTO_MEAN", 20.5)]
    assert [(r.key, r.value) for r in qc.log_lines(log("ALL_READS\t20\nSTAT\tx\t3"), "bc_auc").collect()] == [("bc_auc.ALL_READS", 20.0)]
