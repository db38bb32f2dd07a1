import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import shards, substring_dedup, suffix_dedup
from tests.llm.cases import corpus, documents, prose, without_strings, without_windows


@pytest.mark.parametrize("seed", [11, 12])
def test_windows_equal_brute_force(spark, seed):
    texts = corpus(seed)
    got = substring_dedup.remove_repeated_windows(documents(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_text) for r in got] == without_windows(texts)
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in got)


@pytest.mark.parametrize("window", [1, 3, 5, 8, 30])
def test_other_window_sizes(spark, window):
    r = random.Random(window)
    texts = [" ".join(r.choice("abc") for _ in range(r.randrange(60))) for _ in range(30)]
    got = substring_dedup.remove_repeated_windows(documents(spark, texts), window=window).orderBy("doc_id").collect()
    assert [(x.n_words, x.n_removed, x.kept_text) for x in got] == without_windows(texts, window)


def test_covers_give_every_difference():
    for period in range(1, 14):
        cover = substring_dedup.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    for window in range(1, 40):
        anchor, period, _ = substring_dedup.plan(window)
        assert anchor >= 1 and anchor + period - 1 == window


@pytest.mark.parametrize("seed", [11, 13])
def test_strings_equal_brute_force(spark, seed):
    texts = corpus(seed)
    out = suffix_dedup.remove_repeated_strings(documents(spark, texts)).select("doc_id", "n_bytes", "n_removed", F.size("removed").alias("n"), F.sha2("kept", 256).alias("h"))
    assert [tuple(r)[1:] for r in out.orderBy("doc_id").collect()] == without_strings(texts)


def test_shared_strings_with_different_neighbours(spark):
    """One passage in many documents, between texts that differ: repeats are found across shards, to the byte."""
    r = random.Random(4)
    passage = prose(r, 60)
    texts = [f"{prose(r, r.randrange(30))}|{passage[r.randrange(80):len(passage) - r.randrange(80)]}|{prose(r, r.randrange(30))}" for _ in range(60)]
    out = suffix_dedup.remove_repeated_strings(documents(spark, texts)).select("doc_id", "n_bytes", "n_removed", F.size("removed").alias("n"), F.sha2("kept", 256).alias("h"))
    assert [tuple(x)[1:] for x in out.orderBy("doc_id").collect()] == without_strings(texts)


def test_rows_without_id_and_with_equal_ids(spark):
    text = prose(random.Random(2), 50)
    ids, texts = [None, 5, 5, 3], [text, text, "short", text]
    for operator in (substring_dedup.remove_repeated_windows, suffix_dedup.remove_repeated_strings):
        got = {(r.doc_id, r.n_removed > 0) for r in operator(documents(spark, texts, ids)).collect()}
        assert got == {(3, False), (5, True), (5, False), (None, True)}


def test_empty_tables(spark):
    none = documents(spark, ["x"]).where("false")
    assert substring_dedup.remove_repeated_windows(none).count() == 0
    assert suffix_dedup.remove_repeated_strings(none).count() == 0


def test_suffixes_and_prefixes_against_sorting():
    r = np.random.default_rng(5)
    for k in range(20):
        text = r.integers(97, 99, r.integers(1, 400)).astype(np.uint8)
        text = np.concatenate([text, text[3:40], text]) if k % 2 else text
        raw = text.tobytes()
        order, packed = suffix_dedup.suffix_array(text)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = suffix_dedup.common_prefixes(order, packed, 100, lanes=5)
        for x in range(1, len(raw)):
            a, b = raw[order[x - 1] :], raw[order[x] :]
            n = next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
            assert shared[x] == min(n, 100)


def test_merging_runs_keeps_the_least_owner():
    runs = [([1, 5, 9], [7, 7, 7]), ([5, 6], [3, 3]), ([1, 6, 9], [8, 2, 1])]
    keys = np.array([k for h, _ in runs for k in h], ">u8").view("S8")
    assert suffix_dedup.least_owners(keys, np.array([d for _, o in runs for d in o])).tolist() == [7, 3, 1, 3, 2, 7, 2, 1]


@pytest.mark.parametrize("hot", [0, 5, 16_384])
def test_many_shards_and_rows_without_ids(spark, monkeypatch, hot):
    """Null ids come last; rows of equal id come by shard and hash. Passages cross the shards, with and without hot anchors."""
    monkeypatch.setattr(shards, "LEAST_SHARDS", 30)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    r = random.Random(14)
    shared = [prose(r, 45) for _ in range(4)]
    texts = [f"{prose(r, r.randrange(40))} {r.choice(shared)} {prose(r, r.randrange(40))}" for _ in range(60)] + [shared[0]] * 5
    ids = [i if i % 3 else None for i in range(60)] + [None] * 3 + [7, 7]
    docs = documents(spark, texts, ids)
    order = [tuple(x) for x in docs.selectExpr("doc_id", "text", "pmod(xxhash64(doc_id, text), 30) part", "xxhash64(text) tie").orderBy(F.col("doc_id").asc_nulls_last(), "part", "tie").select("doc_id", "text").collect()]
    want = without_windows([t for _, t in order])
    got = substring_dedup.remove_repeated_windows(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *w)) for (i, _), w in zip(order, want, strict=True))
    want = without_strings([t for _, t in order])
    got = suffix_dedup.remove_repeated_strings(docs).select("doc_id", "n_bytes", "n_removed", F.size("removed").alias("n"), F.sha2("kept", 256).alias("h")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *w)) for (i, _), w in zip(order, want, strict=True))
