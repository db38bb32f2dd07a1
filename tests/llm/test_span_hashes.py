import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallyweave.llm import span_hashes
from tests.llm.cases import corpus, documents, prose

P = (1 << 61) - 1


def test_products_and_prefixes_modulo_the_prime():
    r = random.Random(1)
    numbers = [0, 1, 2, P - 1, P - 2, 1 << 60, 1 << 31, (1 << 31) - 1] + [r.randrange(P) for _ in range(50)]
    for x in numbers:
        got = span_hashes.product(np.full(len(numbers), x, np.uint64), np.array(numbers, np.uint64))
        assert got.tolist() == [x * y % P for y in numbers]
    text = "aé\U0001f600z" * 50
    sums = span_hashes.Prefixes(span_hashes.points(text)).sums.tolist()
    want = [0]
    for i, c in enumerate(text):
        want.append((want[-1] + (ord(c) + 1) * pow(span_hashes.BASE, i, P)) % P)
    assert sums == want


def test_equal_spans_and_common_extensions():
    r = random.Random(2)
    a, b = ("".join(r.choice("ab") for _ in range(400)) for _ in range(2))
    b = b[:100] + a[50:250] + b[100:]
    x, y = (span_hashes.Prefixes(span_hashes.points(t)) for t in (a, b))
    i, j = (np.array([r.randrange(len(t)) for _ in range(500)] + [50]) for t in (a, b))
    j[-1] = 100

    def longest(s, t):
        n = 0
        while n < min(len(s), len(t)) and s[n] == t[n]:
            n += 1
        return n

    assert span_hashes.common_extension(x, i, y, j).tolist() == [longest(a[s:], b[t:]) for s, t in zip(i, j, strict=True)]
    n = np.minimum(5, np.minimum(len(a) - i, len(b) - j))
    assert span_hashes.equal(x, i, y, j, n).tolist() == [a[s : s + k] == b[t : t + k] for s, t, k in zip(i, j, n, strict=True)]
    assert span_hashes.common_prefix(x, x) == 400 and span_hashes.common_prefix(x, y) == longest(a, b)


def share(a, b, span=span_hashes.SPAN):
    """The exact share: places whose span has a partner, of all places of both."""
    x, y = (Counter(t[max(0, e - span) : e] if e >= span else (e, t[:e]) for e in range(1, len(t) + 1)) for t in (a, b))
    return 2 * sum((x & y).values()) / (len(a) + len(b)) if a or b else 1.0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 30, 100, 128])
def test_short_texts_are_counted_whole(n):
    r = random.Random(n)
    a = "".join(r.choice("abc ") for _ in range(n))
    for b in (a, a[: n - n // 4] + "zz", "z" * n, "", a[: n // 2]):
        if len(b) <= span_hashes.KEPT:
            assert span_hashes.likeness(span_hashes.Fingerprint(a), span_hashes.Fingerprint(b)) == pytest.approx(share(a, b))


def test_longer_texts_are_estimated():
    r = random.Random(3)
    off = []
    for _ in range(60):
        a = prose(r, r.randrange(40, 800))
        b = span_hashes.edited(a, prose(r, 800)) if r.random() < 0.7 else a[: len(a) // 3] + prose(r, 100)
        off.append(span_hashes.likeness(span_hashes.Fingerprint(a), span_hashes.Fingerprint(b)) - share(a, b))
    assert max(map(abs, off)) < 0.2 and abs(sum(off) / len(off)) < 0.02
    same = span_hashes.Fingerprint("x" * 1000)
    assert span_hashes.likeness(same, span_hashes.Fingerprint("x" * 999 + "y")) > 0.9
    assert span_hashes.likeness(same, span_hashes.Fingerprint(prose(r, 500))) < 0.1


@pytest.mark.parametrize("part_bytes", [300, 64 << 20])
def test_every_document_with_its_next(spark, part_bytes):
    texts = corpus()
    ids = [None if i % 11 == 5 else i // 3 for i in range(len(texts))]  # missing and repeated ids
    got = span_hashes.fingerprints(documents(spark, texts, ids), part_bytes=part_bytes).collect()
    order = sorted(((i is None, i or 0, (xxhash.xxh64((t or "").encode(), seed=42).intdigest() + (1 << 63)) % (1 << 64), t or "", i) for i, t in zip(ids, texts, strict=True)))
    want = []
    for k, (*_, text, i) in enumerate(order):
        following = order[(k + 1) % len(order)][3]
        q = len(text) // 4
        new = text[: len(text) - q] + following[:q]
        a, b, c = (span_hashes.Fingerprint(t) for t in (text, new, following))
        want.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), a.text, b.text, span_hashes.likeness(a, b), span_hashes.likeness(a, c)))
    assert sorted(map(str, (tuple(g)[:7] for g in got))) == sorted(map(str, want))
    for g in got:
        assert (g["near_edited"] == 1) == (g["fingerprint"] == g["edited_fingerprint"])


def test_one_row_and_none(spark):
    assert span_hashes.fingerprints(documents(spark, ["x"]).limit(0)).count() == 0
    one = span_hashes.fingerprints(documents(spark, ["abcdefgh"])).collect()
    assert [(g["n_chars"], g["near_next"], g["common_edited"], g["common_next"]) for g in one] == [(8, 1.0, 6, 8)]
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


def test_one_id_in_most_rows_is_dealt_over_ranges(spark):
    r = random.Random(4)
    texts = [prose(r, 20) for _ in range(300)]
    df = documents(spark, texts, [7] * 300)
    rows = span_hashes.with_next(df, part_bytes=2000).where("guard = 0").groupBy("part").count().collect()
    assert len(rows) > 8 and max(row["count"] for row in rows) < 100
