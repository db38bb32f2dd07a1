import gzip
from pathlib import Path

import pytest

from tallyweave.plans import unify


def tables(spark, measured, kind="long"):
    samples = spark.createDataFrame([("S1", s) for s in "abcd"] + [("S2", "z")], "study string, sample string")
    features = spark.createDataFrame([(i, "A1") for i in range(5)], "gene long, annotation string")
    return spark.createDataFrame(measured, f"gene long, sample string, sum {kind}"), features, samples


def counts(rows):
    return {(r["study"], r["gene"]): list(r["counts"]) for r in rows.collect()}


def test_counts_stand_in_the_samples_order_with_zeros_between(spark):
    measured = [(0, "a", 1), (0, "d", 4), (1, "b", 2), (1, "c", 3), (2, "d", 9), (2, "z", 7), (3, "a", None), (3, "b", 5), (3, "unknown", 8)]
    got = counts(unify.study_rows(*tables(spark, measured), ["gene"]))
    assert [got["S1", g] for g in range(5)] == [[1, 0, 0, 4], [0, 2, 3, 0], [0, 0, 0, 9], [0, 5, 0, 0], [0, 0, 0, 0]]
    assert [got["S2", g] for g in range(5)] == [[0], [0], [7], [0], [0]]
    assert counts(unify.study_rows(*tables(spark, [(1, "c", 0.5)], "double"), ["gene"]))["S1", 1] == [0, 0, 0.5, 0]
    assert set(map(tuple, counts(unify.study_rows(*tables(spark, []), ["gene"])).values())) == {(0, 0, 0, 0), (0,)}


def test_two_values_of_a_sample_for_one_feature_are_an_error(spark):
    with pytest.raises(Exception, match="two values"):
        unify.study_rows(*tables(spark, [(1, "c", 1), (1, "c", 2)]), ["gene"]).collect()


def test_a_large_study_is_several_files_that_make_one(spark, tmp_path):
    n = 3000
    samples = spark.createDataFrame([("S1", "a"), ("S1", "b"), ("S2", "c")], "study string, sample string")
    features = spark.createDataFrame([(i, "A1" if i % 3 else "B1") for i in range(n)], "gene long, annotation string")
    long = spark.createDataFrame([(i, "b", i) for i in range(n)], "gene long, sample string, sum long")
    unify.write_studies(unify.study_rows(long, features, samples, ["gene"]), str(tmp_path / "out"), ["gene"], ["annotation"], parts=16)
    files = sorted(Path(tmp_path, "out", "study_lo=S1", "study=S1", "annotation=A1").glob("part-*"))
    assert len(files) > 2
    whole = gzip.decompress(b"".join(f.read_bytes() for f in files)).decode().splitlines()
    assert whole == ["##annotation=A1", "gene\ta\tb", *(f"{i}\t0\t{i}" for i in range(n) if i % 3)]
    other = sorted(Path(tmp_path, "out", "study_lo=S2", "study=S2", "annotation=B1").glob("part-*"))
    lines = gzip.decompress(b"".join(f.read_bytes() for f in other)).decode().splitlines()
    assert lines == ["##annotation=B1", "gene\tc", *(f"{i}\t0" for i in range(0, n, 3))]
