import random

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import intervals

VALUES = "chrom string, start long, end long, value long, line long"


def painted(values):
    """Each base's value, later lines over earlier."""
    out = {}
    for c, s, e, v, _ in sorted(values, key=lambda r: r[4]):
        for b in range(s, e):
            out[c, b] = v
    return out


def make(seed, n=200, depth=60):
    r = random.Random(seed)
    return [(r.choice("ab"), s := r.randrange(300), s + r.randrange(0, depth), r.randrange(-3, 9), i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_later_lines_overwrite_earlier(spark, seed):
    values = make(seed)
    r = random.Random(seed)
    r.shuffle(values)
    got = intervals.last_writer(spark.createDataFrame(values, VALUES)).collect()
    bases = [((g.chrom, b), g.value) for g in got for b in range(g.start, g.end)]
    assert len(bases) == len(dict(bases)) and dict(bases) == painted(values)


def test_values_of_any_type_and_no_key(spark):
    df = spark.createDataFrame([(0, 10, "x", 1), (5, 7, None, 2), (9, 9, "y", 3)], "start long, end long, value string, line int")
    got = sorted((b, g.value) for g in intervals.last_writer(df, on=()).collect() for b in range(g.start, g.end))
    assert got == [(b, None if b in (5, 6) else "x") for b in range(10)]
    assert intervals.last_writer(df.limit(0), on=()).count() == 0


def test_a_thousand_deep_makes_rows_in_proportion(spark):
    df = spark.range(1000).select(F.lit("c").alias("chrom"), F.col("id").alias("start"), (F.col("id") + 1_000_000).alias("end"), F.col("id").alias("value"), F.col("id").alias("line"))
    got = intervals.last_writer(df)
    assert got.count() <= 2 * 1000 + 4 * 1000  # two bounds an interval, and what the borders of four ranges cut
    last = got.orderBy(F.desc("end")).first()
    assert (last.value, last.end) == (999, 1_000_999) and got.agg(F.sum(F.col("end") - F.col("start"))).first()[0] == 1_000_999


@pytest.mark.parametrize("seed", [1, 2])
def test_region_sums_equal_sums_of_bases(spark, seed):
    r = random.Random(seed)
    flat = intervals.last_writer(spark.createDataFrame(make(seed), VALUES))
    bases = painted(make(seed))
    regions = [(r.choice(["a", "b", "z", None]), s := r.randrange(320), s + r.randrange(0, 200), i % 30) for i in range(90)]
    regions += regions[:5]  # equal rows
    df = spark.createDataFrame(regions, "chrom string, start long, end long, side long")
    want = sorted((str(c), s, e, i, sum(bases.get((c, b), 0) for b in range(s, e))) for c, s, e, i in regions)
    assert sorted((str(g.chrom), g.start, g.end, g.side, g.value) for g in intervals.summarise_regions(df, flat, "sum").collect()) == want
    means = sorted((str(g.chrom), g.start, g.end, g.side, -1 if g.value is None else g.value) for g in intervals.summarise_regions(df, flat).collect())
    for got, (c, s, e, i, v) in zip(means, want, strict=True):
        assert got[:4] == (c, s, e, i) and got[4] == pytest.approx(v / (e - s) if e > s else -1)


def test_rows_do_not_grow_with_region_length(spark):
    values = spark.range(500).select(F.lit("c").alias("chrom"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 5).alias("end"), F.lit(2).alias("value"))
    for length in (10, 5000):
        regions = spark.range(40).select(F.lit("c").alias("chrom"), F.col("id").alias("start"), (F.col("id") + length).alias("end"))
        assert intervals._area_events(regions, values, ["chrom"]).count() == 500 + 2 * 40
    total = intervals.summarise_regions(regions.where("start = 0"), values, "sum").first().value
    assert total == 5000


def test_no_values_or_regions(spark):
    none = spark.createDataFrame([], "chrom string, start long, end long, value long")
    region = spark.createDataFrame([("c", 1, 5)], "chrom string, start long, end long")
    assert [tuple(r) for r in intervals.summarise_regions(region, none, "sum").collect()] == [("c", 1, 5, 0)]
    assert intervals.summarise_regions(region.limit(0), none).count() == 0


@pytest.mark.parametrize("block", [7, 1 << 18])
@pytest.mark.parametrize("keyed", [True, False])
def test_blocks_of_any_size_give_the_same(spark, monkeypatch, block, keyed):
    from tallyweave.operators import ranges

    monkeypatch.setattr(ranges, "BLOCK", block)
    r = random.Random(9)
    iv = [(r.choice(["a", "b", None]) if keyed else "a", s := r.randrange(900), s + r.choice([0, 3, 12, 300 if r.random() < 0.05 else 5])) for _ in range(250)]
    df = spark.createDataFrame(iv, "chrom string, start long, end long").repartition(3)
    on = ["chrom"] if keyed else []
    for c in {x[0] for x in iv}:
        mine = sorted((s, e) for k, s, e in iv if k == c)
        base = {p for s, e in mine for p in range(s, e + 1)}
        runs: list = []
        for s, e in mine:
            if runs and s - runs[-1][1] < 2:
                runs[-1][1] = max(runs[-1][1], e)
            else:
                runs.append([s, e])
        own = F.col("chrom").eqNullSafe(F.lit(c)) if keyed else F.lit(True)
        assert sorted([x.start, x.end] for x in intervals.coalesce(df, 2, on).where(own).collect()) == runs
        cut = sorted((x.start, x.end) for x in intervals.disjoin(df, on).where(own).collect())
        bounds = sorted({s for s, _ in mine} | {e + 1 for _, e in mine})
        assert cut == [(x, y - 1) for x, y in zip(bounds, bounds[1:], strict=False) if x in base]
