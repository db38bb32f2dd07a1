import random
import re

import numpy as np
import pytest

from tallyweave.llm import decontaminate
from tests.llm.cases import documents, edit_distance_in, prose


def edited(r, text, n):
    s = list(text)
    for _ in range(n):
        i = r.randrange(len(s))
        k = r.randrange(3)
        s[i : i + (k != 1)] = [] if k == 0 else [r.choice("xyzw")]
    return "".join(s)


@pytest.fixture(scope="module")
def case(spark):
    r = random.Random(9)
    items = [(i, prose(r, 30)) for i in range(12)] + [(50, None), (51, ""), (52, "short"), (53, "tiny bench")]
    texts = [None, "", "a tiny bench here"]
    for i in range(60):
        text = prose(r, 60)
        if i % 3 == 0:
            item = items[i % 12][1]
            n = int(len(item.encode()) * r.choice([0, 0.03, 0.07, 0.1, 0.3]))
            text = text[:100] + " " + edited(r, item, n).upper().replace("É", "é").replace(" ", "\n") + " " + text[100:]
        texts.append(text)
    texts.append(" ".join([items[0][1]] * 2))
    return items, texts, documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")


def test_passages_equal_brute_force(case):
    items, texts, docs, benchmark = case
    got = decontaminate.passages(docs, benchmark).collect()
    norm = lambda t: bytes(0x20 if c in b"\t\n\v\f\r" else c for c in t.encode().lower())
    want = {}
    for d, text in enumerate(texts):
        for i, item in items:
            if text and item:
                if len(norm(item)) < decontaminate.GRAM:
                    if norm(item) in re.split(rb"\W+", norm(text)):
                        want[d, i] = 0
                    continue
                m = len(norm(item))
                k = min(int(decontaminate.EDIT_SHARE * m), (m - decontaminate.GRAM) // decontaminate.GRAM)
                n = edit_distance_in(norm(item), norm(text))
                if n <= k:
                    want[d, i] = n
    assert {(r.doc_id, r.item_id) for r in got} == set(want)
    best = {}
    for r in got:
        best[r.doc_id, r.item_id] = min(r.edits, best.get((r.doc_id, r.item_id), 99))
        part = texts[r.doc_id].encode()[r.start : r.end]
        assert edit_distance_in(norm(dict(items)[r.item_id]), norm(part.decode(errors="replace"))) <= r.edits + 4
    assert best == want
    assert sum(r.doc_id == len(texts) - 1 and r.item_id == 0 for r in got) == 2


def test_clean_rows_stay_and_long_texts_are_cut(case, spark, monkeypatch):
    items, texts, docs, benchmark = case
    whole = sorted(map(tuple, decontaminate.passages(docs, benchmark).collect()))
    bad = {r[0] for r in whole}
    left = decontaminate.without_passages(docs, benchmark)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(range(len(texts))) - bad
    long = " ".join(t for t in texts if t)  # some thirty thousand bytes as one text
    one = sorted((r.item_id, long.encode()[r.start : r.end]) for r in decontaminate.passages(documents(spark, [long]), benchmark).collect())
    assert one == sorted((i, texts[d].encode()[s:e]) for d, i, s, e, _ in whole)
    monkeypatch.setattr(decontaminate, "STRETCH", 1 << 20)
    assert one == sorted((r.item_id, long.encode()[r.start : r.end]) for r in decontaminate.passages(documents(spark, [long]), benchmark).collect())


def test_short_items_are_found_as_whole_words(spark):
    docs = documents(spark, ["the answer is BORDEAUX here", "bordeauxs", "Bordeaux", "a\tb, é", None, "xa b"])
    benchmark = spark.createDataFrame([(1, "Bordeaux"), (2, "Bordeaux "), (3, "a b"), (4, "é"), (5, " ")], "item_id long, text string")
    got = sorted(map(tuple, decontaminate.passages(docs, benchmark).collect()))
    assert got == [(0, 1, 14, 22, 0), (0, 2, 14, 22, 0), (2, 1, 0, 8, 0), (2, 2, 0, 8, 0), (3, 3, 0, 3, 0), (3, 4, 5, 7, 0)]
    assert {r.doc_id for r in decontaminate.without_passages(docs, benchmark).collect()} == {1, 4, 5}


def test_null_and_repeated_rows(case, spark):
    """Each row counts by its own text, whatever its id; equal rows share their fate."""
    items, *_ = case
    texts, ids = [items[0][1], "clean text here", items[0][1], items[0][1], None], [None, None, 7, 7, 7]
    docs = documents(spark, texts, ids)
    benchmark = spark.createDataFrame([items[0], (99, items[0][1]), (None, items[0][1])], "item_id long, text string")
    got = decontaminate.passages(docs, benchmark).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in got) == sorted((d, i) for d in ("None", "7", "7") for i in ("0", "99", "None"))
    assert {(r.doc_id, r.text) for r in decontaminate.without_passages(docs, benchmark).collect()} == {(None, "clean text here"), (7, None)}


def test_banded_alignment_equals_the_full_table():
    r = random.Random(3)
    for _ in range(200):
        item = "".join(r.choice("abcd") for _ in range(r.randrange(3, 40)))
        text = "".join(r.choice("abcd") for _ in range(r.randrange(5))) + edited(r, item, r.randrange(6)) + "".join(r.choice("abcd") for _ in range(r.randrange(5)))
        most = r.randrange(5)
        want = edit_distance_in(item, text)
        got = decontaminate.align(np.frombuffer(item.encode(), np.uint8), np.frombuffer(text.encode(), np.uint8), most)
        assert (got is None) == (want > most)
        if got:
            assert got[2] == want and edit_distance_in(item, text[got[0] : got[1]]) == want


def test_parts_of_items(spark):
    r = random.Random(31)
    item = prose(r, 120)
    n = len(item)
    parts = {0: item[: n // 2], 1: item[n // 5 :], 2: item[40:150], 3: edited(r, item[100:300], 6), 5: item}
    texts = [f"{prose(r, 30)} {parts[i]} {prose(r, 30)}" if i in parts else prose(r, 90) for i in range(5)] + [f"{prose(r, 30)} {item}"]
    texts.append(prose(r, 30) + " " + item[:160])  # cut off by the end of the text
    docs, benchmark = documents(spark, texts), spark.createDataFrame([(7, item)], "item_id long, text string")
    got = sorted(map(tuple, decontaminate.passages(docs, benchmark, window=100).collect()))
    assert [x[0] for x in got] == [0, 1, 2, 3, 5, 6]
    for d, _, start, end, edits in got:
        want = parts.get(d, item[:160])
        at = texts[d].encode().index(want.encode())
        assert abs(start - at) <= 10 and abs(end - at - len(want.encode())) <= 10 and edits <= 20
    assert {x[0] for x in decontaminate.passages(docs, benchmark).collect()} == {5}
    left = decontaminate.without_passages(docs, benchmark, window=100)
    assert {x.doc_id for x in left.collect()} == {4}


def test_empty_tables(case):
    _, texts, docs, benchmark = case
    assert decontaminate.passages(docs.where("false"), benchmark).count() == 0
    assert decontaminate.passages(docs, benchmark.where("false")).count() == 0
    assert decontaminate.without_passages(docs, benchmark.where("false")).count() == len(texts)


def test_periodic_texts_and_items(spark):
    """Rules of dashes and table lines against items of the same: found, once for equal texts, with work that doesn't multiply."""
    import time

    items = [(i, "-" * 300 + c) for i, c in enumerate("abcdefghijklmnopqrst")] + [(99, "| a | b " * 40 + "z")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["-" * 4000] * 200 + ["intro | a | b " + "| a | b " * 300, "-" * 50, "- " * 400]
    began = time.time()
    found = decontaminate.passages(documents(spark, texts), bench, window=100).collect()
    assert time.time() - began < 120
    by_doc = {}
    for f in found:
        by_doc.setdefault(f.doc_id, set()).add(f.item_id)
    assert all(by_doc[i] == set(range(20)) for i in range(200)) and by_doc[200] == {99} and 201 not in by_doc and 202 not in by_doc


def test_runs_of_equal_grams_count_as_their_pairs_do():
    import numpy as np

    r = random.Random(2)
    for _ in range(200):
        text, item = ("".join(r.choice(["ab" * 8, "-" * 15, "xyz", "a"]) for _ in range(r.randrange(1, 8))).encode() for _ in range(2))
        q = 10
        runs = []
        for t in (text, item):
            buf = np.frombuffer(t, np.uint8)
            codes = decontaminate.gram_codes(buf, q)
            runs.append([x for x in zip(*(v.tolist() for v in decontaminate._runs(codes, np.arange(len(codes)), q)), strict=True)])
        got = {}
        for c, a, n, p in runs[0]:
            for d, b, m, s in runs[1]:
                if c == d:
                    for t in range(1 - m, n):
                        k = a - b + max(p, s) * t
                        got[k] = got.get(k, 0) + min(n - 1, m - 1 + t) - max(0, t) + 1
        want = {}
        for i in range(len(text) - q + 1):
            for j in range(len(item) - q + 1):
                if text[i : i + q] == item[j : j + q]:
                    want[i - j] = want.get(i - j, 0) + 1
        assert got == want
