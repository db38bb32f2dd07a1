import threading

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import ids
from tallyweave.sources import deltas
from tallyweave.versions import Versions


def test_of_two_commits_after_one_version_one_wins(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "v"))
    assert v.current() == (0, {})
    won = []
    ts = [threading.Thread(target=lambda i=i: won.append(v.commit(0, {"i": i}))) for i in range(8)]
    [t.start() for t in ts]
    [t.join() for t in ts]
    assert sorted(won) == [False] * 7 + [True] and v.current()[0] == 1
    assert v.commit(1, {"a": 2}) and v.current() == (2, {"a": 2})
    assert not list((tmp_path / "v" / "_versions").glob("*.json.*"))


def sample(spark, names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "accession string, i long")


def test_two_writers_never_give_one_id_twice(spark, tmp_path):
    state = str(tmp_path / "ids")
    first = ids.assign_saved(sample(spark, ["SRR1111", "SRR2111"]), 1, "i", state)
    assert sorted(r.counter for r in first.collect()) == [0, 1]
    results, kept = {}, Versions(spark, state)
    meet = threading.Barrier(2, timeout=120)
    real = Versions.commit

    def commit(self, after, content):
        if after == 1 and not meet.broken:  # both have read version 1 before either commits
            meet.wait()
        return real(self, after, content)

    def run(name, accessions):
        results[name] = {r.accession: (r.rail_id, r.counter) for r in ids.assign_saved(sample(spark, accessions), 1, "i", state).collect()}

    Versions.commit = commit
    try:
        ts = [threading.Thread(target=run, args=(n, a)) for n, a in (("a", ["SRR3111", "SRR4111"]), ("b", ["SRR5111", "SRR1111"]))]
        [t.start() for t in ts]
        [t.join() for t in ts]
    finally:
        Versions.commit = real
    assert kept.current()[0] == 3  # the loser came again
    every = {**results["a"], **results["b"]}
    assert len({r for r, _ in every.values()}) == len(every) == 4
    assert every["SRR1111"][1] in (0, 1) and sorted(c for n, (_, c) in every.items() if n != "SRR1111") == [2, 3, 4]
    again = ids.assign_saved(sample(spark, ["SRR3111", "SRR4111"]), 1, "i", state).collect()
    assert {r.accession: (r.rail_id, r.counter) for r in again} == results["a"]


def test_upserts_and_compaction(spark, tmp_path):
    schema = "gene string, place string, samples string, n int, total long"
    t = deltas.KeyedTable(spark, str(tmp_path / "t"))
    t.create(spark.createDataFrame([("a", "c:1", ",1:5", 1, 5), ("b", "c:2", ",2:6", 1, 6), ("c", None, "", 0, None)], schema), ["gene"], ["samples", "n", "total"])
    new = lambda *rows: spark.createDataFrame(list(rows), "gene string, samples string, n int, total long")
    t.upsert(new(("a", ",1:9", 1, 9), ("c", ",3:1", 1, 1)))
    t.upsert(new(("a", None, 0, None)))
    t.upsert(new(("d", ",9:9", 1, 9)).withColumn("place", F.lit("c:9")))
    want = [("a", "c:1", None, 0, None), ("b", "c:2", ",2:6", 1, 6), ("c", None, ",3:1", 1, 1), ("d", "c:9", ",9:9", 1, 9)]
    assert sorted(map(tuple, t.read().collect())) == want
    before = t.read()
    t.compact()
    t.upsert(new(("b", ",2:7", 1, 7)))
    assert sorted(map(tuple, before.collect())) == want
    t.clean()
    assert [r.total for r in t.read().orderBy("gene").collect()] == [None, 7, 1, 9]
    assert len(list((tmp_path / "t").glob("base-*"))) == 1 and len(list((tmp_path / "t").glob("delta-*"))) == 1
    with pytest.raises(ValueError):
        t.create(new(("a", "", 0, 0)), ["gene"], ["n"])


def test_lines_are_found_by_their_key(spark):
    lines = ["1\tc\t5\tG1.2:name:x\t,3:4,5:6\t2\t10", "2\tc\t9\tG2:n\t,1:1\t1\t1", "3\tc\t9\tG3:n\t\t0\t0", "no samples, here"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [r[0] for r in df.select(deltas.key_of_line(F.col("line"))).collect()] == ["G1.2", "G2", None, None]
    new = spark.createDataFrame([("G1.2", ",7:7\t1\t7"), ("G3", "x")], "key string, new string")
    assert sorted(r.line for r in deltas.updated_lines(df, new).collect()) == sorted(["1\tc\t5\tG1.2:name:x\t,7:7\t1\t7", *lines[1:]])
