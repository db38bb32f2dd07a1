import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import toxicity
from tests.llm.cases import documents, prose

BAD = ("vilegrub", "mudbrain", "réxor")


def labelled(n=400, seed=3):
    r = random.Random(seed)
    texts, toxic = [], []
    for i in range(n):
        ws = prose(r, r.randrange(20, 80)).split()
        if i % 4 == 0:
            for _ in range(r.randrange(1, 4)):
                ws.insert(r.randrange(len(ws)), r.choice(BAD).capitalize() if r.random() < 0.3 else r.choice(BAD))
        texts.append(" ".join(ws) + ".")
        toxic.append(int(i % 4 == 0))
    return texts, toxic


def test_marginals_equal_enumeration():
    r = np.random.default_rng(2)
    moves, size = r.normal(size=(2, 2)), np.array([4, 2, 1])
    emit = r.normal(size=(3, 4)) * (np.arange(4) < size[:, None])
    got, pairs = toxicity.forward_backward(emit, size, moves)
    want = np.zeros((2, 2))
    for row, n in enumerate(size):
        weight = {t: np.exp(sum(emit[row, i] * x for i, x in enumerate(t)) + sum(moves[a, b] for a, b in itertools.pairwise(t))) for t in itertools.product((0, 1), repeat=int(n))}
        total = sum(weight.values())
        for i in range(n):
            assert got[row, i] == pytest.approx(sum(w for t, w in weight.items() if t[i]) / total)
        for t, w in weight.items():
            for a, b in itertools.pairwise(t):
                want[a, b] += w / total
    assert pairs == pytest.approx(want)


def test_chains_counted_by_kind_fit_as_all_of_them_do(monkeypatch):
    texts, toxic = labelled(300)
    # also texts of many sentences, and of repeated, one-word and very long ones
    texts += [". ".join([prose(random.Random(i), 9)] * 40) for i in range(20)] + ["one. two. two", prose(random.Random(5), 500)] * 5
    mixed = np.random.default_rng(1).permutation(len(texts))  # fitting takes every other one for the curve
    texts, toxic = [texts[i] for i in mixed], np.array([*toxic, *[0] * (len(texts) - len(toxic))], bool)[mixed]
    weight = np.where(toxic, 1.0, 2.5)
    got = toxicity.fit(texts, toxic, 20, weight)
    monkeypatch.setattr(toxicity, "_kinds", lambda size, weight: (np.arange(len(size)), np.ones(len(size))))
    want = toxicity.fit(texts, toxic, 20, weight)
    assert len(got.codes) and (got.codes == want.codes).all()
    for a, b in zip((got.weights, got.bias, got.moves, got.curve), (want.weights, want.bias, want.moves, want.curve), strict=True):
        assert a == pytest.approx(b, rel=1e-6, abs=1e-6)


def test_held_out_accuracy_and_spans(spark):
    texts, toxic = labelled()
    texts += [None, "", "123 --", texts[0] * 200]
    docs = documents(spark, texts)
    labels = spark.createDataFrame(list(enumerate(toxic)) + [(None, 1), (9999, None)], "doc_id long, toxic int")
    usable = F.crc32(F.col("id").cast("string")) % 5 != 0
    model = toxicity.train(docs, labels, usable)
    got = toxicity.score(docs, model).withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 5 == 0).orderBy("doc_id").collect()
    held = [r for r in got[:400] if r.held]
    assert sum((r.score >= 0.5) == bool(toxic[r.doc_id]) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    marked = {texts[r.doc_id][s.start : s.end].lower() for r in got[:400] if toxic[r.doc_id] for s in r.spans}
    assert set(BAD) <= marked
    kept = {r.doc_id for r in toxicity.below(docs, model).collect()}
    assert kept == {r.doc_id for r in got if r.score < 0.5}


def test_the_sample_keeps_the_labels_shares(spark):
    """One word is in most toxic documents, yet most documents with it are clean."""
    r = random.Random(5)
    texts, toxic = [], []
    for _ in range(3000):
        bad = r.random() < 0.1
        ws = prose(r, 12).split()
        if r.random() < (0.6 if bad else 0.15):
            ws.append("grumblish")
        texts.append(" ".join(ws) + ".")
        toxic.append(int(bad))
    docs, labels = documents(spark, texts), spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    few, every = (toxicity.train(docs, labels, rows=n) for n in (250, 3000))
    assert few.base == pytest.approx(sum(toxic) / 3000) == every.base
    for model in (few, every):
        got = [x.score for x in toxicity.score(docs, model).collect() if "grumblish" in texts[x.doc_id]]
        assert sum(x < 0.5 for x in got) >= 0.95 * len(got)
        assert 0.15 < sum(got) / len(got) < 0.5


def test_long_and_repeated_documents_are_learnt_from_within_bounds(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_TEXT", 4_000)
    seen = []
    plain_fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda texts, *a, **k: seen.append(texts) or plain_fit(texts, *a, **k))
    texts, toxic = labelled(200)
    long = " ".join(texts * 3)  # some hundred thousand characters
    texts, ids = [*texts, long, *texts[:1] * 700], [*range(200), 200, *[0] * 700]
    docs = documents(spark, texts, ids)
    labels = spark.createDataFrame([*enumerate(toxic), (200, 1)], "doc_id long, toxic int")
    toxicity.train(docs, labels, rows=150)
    assert len(seen[0]) == 300 and max(map(len, seen[0])) < 12_000
    toxicity.train(docs.where("doc_id > 0"), labels)
    part = next(t for t in seen[1] if "\n" in t)
    assert 1_000 < len(part) < 12_000 and all(c in long for c in part.split("\n"))
    got = toxicity.score(docs, plain_fit([], np.zeros(0, bool))).count()
    assert got == len(texts)


def test_nothing_to_learn_from(spark):
    docs = documents(spark, ["a b", None])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(0, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, one)).collect()} == {1.0}
    assert toxicity.score(docs.where("false"), toxicity.train(docs, one)).count() == 0
