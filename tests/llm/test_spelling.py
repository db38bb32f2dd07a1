import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyweave.llm import spelling
from tests.llm.cases import documents


def restated(rows, least_length=6, least_count=5, every=199, times=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least_count}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        out[w] = [best if best is not None and words[best] >= times * n else None, n, len(close)]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].append(root)
    return sorted((w, f, r, n, k, words[f] if f else None) for w, (f, n, k, r) in out.items())


def corpus(seed=2):
    r = random.Random(seed)
    base = ["".join(r.choice("abéÿ") for _ in range(r.randrange(5, 9))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "interval", "intervals", "interfal", "x" * 300, "x" * 301, "x" * 299 + "y"]
    texts = [None, "", "12 34", "×÷ ÀÉ"]
    for _ in range(120):
        ws = [r.choice(base) for _ in range(60)]
        ws += [base[0]] * 30 if r.random() < 0.5 else []
        texts.append(" ".join(w.upper() if r.random() < 0.1 else w for w in ws))
    return texts


@pytest.mark.parametrize(("block", "joined"), [(1024, 128), (3, 2)])
def test_equals_brute_force(spark, monkeypatch, block, joined):
    monkeypatch.setattr(spelling, "JOINED", joined)
    monkeypatch.setattr(spelling.links, "__defaults__", (block,))
    texts = corpus()
    ids = [None if i % 50 == 3 else i // 2 for i in range(len(texts))]
    got = spelling.variants(documents(spark, texts, ids), every=19).collect()
    assert sorted((g["word"], g["form"], g["root"], g["n"], g["n_near"], g["form_n"]) for g in got) == restated(list(zip(ids, texts, strict=True)), every=19)


def test_chains_of_forms(spark):
    texts = [" ".join(["letters"] * 700 + ["leters"] * 130 + ["lettxrs"] * 135 + ["letxrs"] * 26 + ["lexxrs"] * 5)]
    got = {g["word"]: (g["form"], g["root"]) for g in spelling.variants(documents(spark, texts), every=10**9).collect()}
    assert got == {"letters": (None, "letters"), "leters": ("letters", "letters"), "lettxrs": ("letters", "letters"), "letxrs": ("lettxrs", "letters"), "lexxrs": ("letxrs", "letters")}


def test_ties_go_to_the_smallest_in_code_point_order(spark):
    texts = [" ".join(["abcdez"] * 25 + ["abcdeé"] * 25 + ["abcdey"] * 5)]
    got = {g["word"]: g["form"] for g in spelling.variants(documents(spark, texts), every=10**9).collect()}
    assert got["abcdey"] == "abcdez"


def test_nothing(spark):
    assert spelling.variants(documents(spark, [None, ""])).count() == 0
    assert spelling.variants(documents(spark, ["x"]).limit(0)).count() == 0


def test_lengths_that_differ_by_two_are_not_near():
    left, right = spelling.near_pairs(["aaaaaa", "aaaaaaa"], ["aaaaaaaa"], 8, "p")
    assert left.tolist() == [1] and right.tolist() == [0]
    same = spelling.near_pairs(["aaaaaa"], ["aaaaaa"], 6, "p")
    assert not np.size(same)
