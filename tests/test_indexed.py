import random

from pyspark.sql import functions as F

from tallyweave.sources import indexed

ROWS = "chrom string, start long, end long, id long"


def table(spark, tmp_path, n=4000, parts=16):
    r = random.Random(4)
    rows = [(r.choice("abc"), s := r.randrange(100_000), s + r.choice([5, 40, 900]), i) for i in range(n)] + [("a", 10, 99_999, -1)]
    indexed.write(spark.createDataFrame(rows, ROWS), str(tmp_path / "t"), parts=parts, block_rows=50)
    return rows, str(tmp_path / "t")


def brute(rows, regions):
    return sorted((x[3], s, e) for c, s, e in regions for x in rows if x[0] == c and x[1] < e and s < x[2] and e > s)


def test_regions_find_all_their_rows_and_open_few_files(spark, tmp_path):
    rows, path = table(spark, tmp_path)
    regions = [("b", 500, 700), ("b", 650, 651), ("c", 40_000, 40_050), ("c", 9, 9), ("z", 1, 5)]
    df = spark.createDataFrame(regions, "chrom string, start long, end long")
    got = indexed.overlapping(spark, path, df)
    assert sorted((g.id, g.start_r, g.end_r) for g in got.collect()) == brute(rows, regions)
    opened = indexed.read(spark, path, df)
    assert len(opened.inputFiles()) <= 3 and len(spark.read.parquet(f"{path}/rows").inputFiles()) == 16
    assert opened.count() < 400
    assert "PushedFilters: [Or" in opened._jdf.queryExecution().toString()


def test_a_long_interval_far_before_a_region_is_found(spark, tmp_path):
    rows, path = table(spark, tmp_path)
    df = spark.createDataFrame([("a", 99_990, 99_998)], "chrom string, start long, end long")
    assert -1 in [g.id for g in indexed.overlapping(spark, path, df).collect()]
    reach = indexed.index(spark, path).where("chrom = 'a'").agg(F.min("reach")).first()[0]
    assert reach == 99_999


def test_many_regions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(indexed, "RANGES", 5)
    rows, path = table(spark, tmp_path, 600, 4)
    r = random.Random(6)
    regions = sorted({(r.choice("abcd"), s := r.randrange(100_000), s + r.randrange(1, 3000)) for _ in range(200)})
    got = indexed.overlapping(spark, path, spark.createDataFrame(regions, "chrom string, start long, end long"))
    assert sorted((g.id, g.start_r, g.end_r) for g in got.collect()) == brute(rows, regions)


def test_no_regions(spark, tmp_path):
    _, path = table(spark, tmp_path, 50, 2)
    none = spark.createDataFrame([], "chrom string, start long, end long")
    assert indexed.overlapping(spark, path, none).count() == 0
