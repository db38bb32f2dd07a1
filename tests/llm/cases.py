"""Small tables with the cases that every operator must take, and plain restatements of the operators."""

import hashlib
import random
import re

#: Names that operators use inside; documents may have such columns too.
CLASHING = ("shard", "bucket", "kind", "band", "key", "node", "label", "lane", "score", "id", "a", "n", "found", "base", "_row_key", "_row_key0", "_row", "_row0", "_bad_digest")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = ("ba", "ce", "di", "fo", "gu", "ha", "ki", "lo", "mé", "nu", "pra", "sto")


def prose(r, n):
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randrange(1, 4))) for _ in range(n))


def documents(spark, texts, ids=None, clash=True):
    """(doc_id, text, …) with columns of clashing names."""
    ids = list(range(len(texts))) if ids is None else ids
    extra = [(f"{c} string") for c in CLASHING] if clash else []
    return spark.createDataFrame([(i, t, *(["x"] * len(extra))) for i, t in zip(ids, texts, strict=True)], ", ".join(["doc_id long", "text string", *extra])).repartition(3)


def corpus(seed=11):
    """Nulls, empty and very long texts, copies, near copies, shared passages and periodic text."""
    r = random.Random(seed)
    shared, long = prose(r, 40), prose(r, 9000)
    base = [prose(r, r.randrange(3, 120)) for _ in range(25)]
    near = [" ".join(w if r.random() > 0.03 else "zz" for w in base[3].split()) for _ in range(6)]
    mixed = [f"{prose(r, 15)} {shared}\t{prose(r, 9)}" for _ in range(5)]
    odd = [None, "", "  \n ", "one", "one", "ab " * 90, "x" * 400, "é" * 150, base[0].upper(), f"{shared} {shared}"]
    return base + near + mixed + odd + [base[1], base[1], long, long + " end", " ".join(shared.split())]


def words(text):
    return WORD.findall(text or "")


def without_windows(texts, size=20):
    """{place: (words, removed, kept text)} in doc_id order."""
    seen, out = set(), []
    for text in texts:
        ws = words(text)
        gone = set()
        for i in range(len(ws) - size + 1):
            w = tuple(ws[i : i + size])
            if w in seen:
                gone.update(range(i, i + size))
            seen.add(w)
        out.append((len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out


def without_strings(texts, size=100):
    """(bytes, removed, spans, sha of the rest) in doc_id order."""
    seen, out = set(), []
    for text in texts:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            s = b[i : i + size]
            if s in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(s)
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def shingles(text, size):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    ws = words(lower)
    return {tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def groups(ids, texts, size, percent):
    """(shingles, smallest linked id) of each document."""
    sets = [shingles(t, size) for t in texts]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and ids[i] is not None and ids[j] is not None and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(len(s), low[find(i)] if d is not None else None) for i, (s, d) in enumerate(zip(sets, ids, strict=True))]


def edit_distance_in(item, text):
    """The fewest edits between item and any part of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
