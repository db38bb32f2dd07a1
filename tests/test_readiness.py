import json

import pytest

from tallyweave.streaming import readiness


@pytest.fixture
def inbox(tmp_path):
    (tmp_path / "in").mkdir()

    def put(name, *markers):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"study": s, "sample": x}) for s, x in markers))

    put.path = str(tmp_path / "in")
    return put


def expect(spark, **n):
    return spark.createDataFrame(list(n.items()), "study string, n long")


def test_each_study_once_over_restarts(spark, tmp_path, inbox):
    seen = []

    def go():
        stream = readiness.markers(spark, inbox.path, per_trigger=1)
        readiness.start(stream, expect(spark, p=2, q=1), lambda df, number: seen.extend(r.study for r in df.collect()), str(tmp_path / "ck")).awaitTermination()

    inbox("1.json", ("p", "a"), ("q", "z"), ("other", "z"))
    go()
    assert seen == ["q"]
    inbox("2.json", ("p", "a"), ("p", None), ("q", "z"))
    go()
    assert seen == ["q"]
    inbox("3.json", ("p", "b"), ("p", "c"))
    inbox("4.json", ("p", "a"), ("p", "b"), ("q", "y"))
    go()
    assert sorted(seen) == ["p", "q"]
    inbox("5.json", ("p", "a"), ("p", "b"), ("q", "z"))
    go()
    assert sorted(seen) == ["p", "q"]
    state = lambda name: spark.read.format("statestore").option("stateVarName", name).load(str(tmp_path / "ck")).count()
    assert state("seen") == 0 and state("count") == 0


def test_a_batch_that_fails_runs_again_with_the_same_studies_and_number(spark, tmp_path, inbox):
    calls = []

    def act(df, number):
        calls.append((number, sorted(r.study for r in df.collect())))
        if len(calls) == 1:
            raise RuntimeError("before the batch is committed")

    def go():
        readiness.start(readiness.markers(spark, inbox.path), expect(spark, p=1, q=1), act, str(tmp_path / "ck")).awaitTermination()

    inbox("1.json", ("p", "a"), ("q", "z"))
    with pytest.raises(Exception, match="before the batch"):
        go()
    go()
    assert calls == [(0, ["p", "q"])] * 2


def test_the_file_sink_holds_each_study_once(spark, tmp_path, inbox):
    for i, markers in enumerate([[("p", "a")], [("p", "b"), ("q", "z")], [("p", "c"), ("q", "z")]]):
        inbox(f"{i}.json", *markers)
        readiness.write_ready(readiness.markers(spark, inbox.path), expect(spark, p=2, q=1), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [("p", 2), ("q", 1)]
