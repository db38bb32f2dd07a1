"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds, for each place, the polynomial of all code points
before it modulo the prime 2**61 - 1, so the hash of any span is two look-ups,
spans are compared whatever their length, and the longest common extension of
two places is a binary search. A fingerprint is made of the spans that end at
each code point: of their hashes, each with its count of earlier equals in the
text, the smallest are kept, and how many of them two texts share tells how
many of their places agree with all that stands shortly before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import textops

PRIME = np.uint64((1 << 61) - 1)

#: The polynomial's base and its inverse modulo the prime.
BASE = 1_442_695_040_888_963_407
INVERSE = pow(BASE, -1, (1 << 61) - 1)

#: Code points of a span, and hashes that a fingerprint keeps, of so many hexadecimal digits each.
SPAN, KEPT, DIGITS = 16, 128, 8

#: Bytes of text in a partition of ordered documents, and sampled keys for each.
PART_BYTES, SAMPLED = 64 << 20, 20

RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_edited long, common_next long"

_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_U1, _U30, _U31, _U61 = (np.uint64(k) for k in (1, 30, 31, 61))


def reduced(x: np.ndarray) -> np.ndarray:
    """Any uint64 modulo the prime."""
    x = (x & PRIME) + (x >> _U61)
    return np.minimum(x, x - PRIME)  # below the prime the difference wraps around to a greater number


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, of numbers below it, in halves of 31 bits, as 2**61 is 1."""
    a1, a0, b1, b0 = a >> _U31, a & _LOW31, b >> _U31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return reduced(((a1 * b1) << _U1) + (middle >> _U30) + ((middle & _LOW30) << _U31) + reduced(a0 * b0))


_POWERS = {base: np.ones(1, np.uint64) for base in (BASE, INVERSE)}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of the base or its inverse modulo the prime; kept for later texts, up to the longest."""
    while len(_POWERS[base]) < n:
        have = _POWERS[base]
        _POWERS[base] = np.concatenate([have, product(have, np.uint64(pow(base, len(have), int(PRIME))))])
    return _POWERS[base][:n]


class Prefixes:
    """The prefix array of a text's code points."""

    def __init__(self, points: np.ndarray):
        terms = product(points.astype(np.uint64) + _U1, powers(BASE, len(points)))
        # sums of halves stay below 2**64 for texts of up to 2**33 code points
        high, low = np.cumsum(terms >> _U31), np.cumsum(terms & _LOW31)
        high = reduced(high)
        self.sums = np.zeros(len(points) + 1, np.uint64)
        self.sums[1:] = reduced((high >> _U30) + ((high & _LOW30) << _U31) + reduced(low))

    def __len__(self) -> int:
        return len(self.sums) - 1

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of spans, the same wherever a span stands."""
        return product(reduced(self.sums[end] + PRIME - self.sums[start]), powers(INVERSE, len(self) + 1)[start])

    def before_each(self, span: int) -> np.ndarray:
        """Hashes of the spans that end at each code point, of the given length, or from the beginning where that is nearer."""
        n = len(self)
        out = self.sums[1:].copy()
        if n > span:
            out[span:] = product(reduced(self.sums[span + 1 :] + PRIME - self.sums[1 : n - span + 1]), powers(INVERSE, n + 1)[1 : n - span + 1])
        return out


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def equal(a: Prefixes, i: np.ndarray, b: Prefixes, j: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether spans of a at i and of b at j, of the given lengths, are equal."""
    return a.spans(i, i + length) == b.spans(j, j + length)


def common_extension(a: Prefixes, i: np.ndarray, b: Prefixes, j: np.ndarray) -> np.ndarray:
    """The longest span that both have at i and j, for many pairs of places at once, by binary search."""
    low = np.zeros(len(i), np.int64)
    high = np.minimum(len(a) - i, len(b) - j)
    while np.any(low < high):
        middle = (low + high + 1) // 2
        same = equal(a, i, b, j, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def common_prefix(a: Prefixes, b: Prefixes) -> int:
    """The longest beginning that both have: prefix hashes themselves are compared."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a.sums[middle] == b.sums[middle] else (low, middle - 1)
    return low


class Fingerprint:
    """n code points, the hash of the whole, and the smallest hashes of spans."""

    def __init__(self, text: str, span: int = SPAN, kept: int = KEPT):
        self.prefixes, self.kept = Prefixes(points(text)), kept
        self.n = len(self.prefixes)
        hashes = np.sort(self.prefixes.before_each(span))
        first = np.flatnonzero(np.concatenate([np.ones(min(1, self.n), bool), hashes[1:] != hashes[:-1]]))
        earlier = np.arange(self.n) - np.repeat(first, np.diff(np.append(first, self.n)))
        each = textops.mix(textops.mix(hashes) + earlier.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(64 - 4 * DIGITS)
        least = np.partition(each, kept - 1)[:kept] if self.n > kept else each
        self.least = np.sort(least)
        self.text = f"{self.n:x}-{int(self.prefixes.sums[-1]):016x}-" + np.ascontiguousarray(self.least.astype(">u4")).tobytes().hex()


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """About the share of both texts' code points with a partner in the other: twice those that agree over all.

    Of the smallest hashes of both texts together, those in both estimate the
    share of the union; texts of up to KEPT code points are counted whole. Two
    empty texts are alike, as are equal ones.
    """
    if a.text == b.text:
        return 1.0
    if not a.n or not b.n:
        return 0.0
    all_values, counts = np.unique(np.concatenate([a.least, b.least]), return_counts=True)
    whole = a.n <= a.kept and b.n <= b.kept
    counts = counts if whole else counts[: min(a.kept, max(len(a.least), len(b.least)))]
    share = float(np.mean(counts > 1))
    return 2 * share / (1 + share)


def _key(doc_id: Column, text: Column) -> Column:
    """A text whose order is that of doc_id, nulls last, and of equal ones of a hash of their texts."""
    ordered = lambda x: F.lpad(F.hex(x.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))), 16, "0")
    return F.concat(F.when(doc_id.isNull(), "1").otherwise("0"), ordered(F.coalesce(doc_id, F.lit(0).cast("long"))), ordered(F.xxhash64(text)))


def _borders(keyed: DataFrame, part_bytes: int) -> list[str]:
    """Keys of rows that begin a range each, the least key first, from a sample by hash of bounded size."""
    n, size, least = keyed.agg(F.count("*"), F.sum(F.octet_length("text")), F.min("key")).first()
    if not n:
        return []
    parts = max(int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // part_bytes))
    share = min(1.0, SAMPLED * parts / n)
    chosen = keyed.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).groupBy("key").agg(F.count("*").alias("k")).orderBy("key").collect()  # some SAMPLED for each part
    total, seen, out = sum(r["k"] for r in chosen), 0, [least]
    for r in chosen:
        if seen * parts >= total * len(out) and r["key"] > out[-1]:
            out.append(r["key"])
        seen += r["k"]
    return out


def _ranged(keyed: DataFrame, borders: list[str]) -> DataFrame:
    """Rows with the number of their range; a range's first row also goes to the one before, the very first to the last, as its guard."""
    width = max(1, int(len(borders) ** 0.5))
    groups = [borders[i : i + width] for i in range(0, len(borders), width)]
    heads = F.array(*(F.lit(g[0]) for g in groups))
    rows = keyed.withColumn("g", F.size(F.filter(heads, lambda h: h <= F.col("key"))))
    inner = F.element_at(F.array(*(F.array(*map(F.lit, g)) for g in groups)), F.col("g"))
    rows = rows.withColumn("at", F.size(F.filter(inner, lambda h: h <= F.col("key"))))
    rows = rows.withColumn("first", F.element_at(inner, F.col("at")) == F.col("key")).withColumn("part", ((F.col("g") - 1) * width + F.col("at") - 1).cast("int"))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("guard"))
    before = F.struct(F.pmod(F.col("part") - 1, F.lit(len(borders))).cast("int").alias("part"), F.lit(1).alias("guard"))
    rows = rows.withColumn("to", F.explode(F.when(F.col("first"), F.array(own, before)).otherwise(F.array(own))))
    return rows.select("to.part", "to.guard", "key", "doc_id", "text")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows (part, guard, key, doc_id, text) in partitions of whole ranges, in order, each ended by its guard: the row that comes next.

    The order is that of doc_id, nulls last, and of equal ids by a hash of
    their texts.
    """
    key, body = F.col(doc_id).cast("long"), F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(_key(key, body).alias("key"), key.alias("doc_id"), body.alias("text"))
    borders = _borders(keyed, part_bytes)
    if not borders:
        return keyed.select(F.lit(0).alias("part"), F.lit(0).alias("guard"), "key", "doc_id", "text")
    return _ranged(keyed, borders).repartition(len(borders), "part").sortWithinPartitions("part", "guard", "key")


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the beginning of the next."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, kept: int = KEPT, part_bytes: int = PART_BYTES) -> DataFrame:
    """Each document's fingerprint, its edited text's, and how like they and the next document's are.

    The next document is that of the next doc_id, after the last the first
    (nulls count as last, rows of equal id follow each other by a hash of their
    texts; a single row is its own next). The edited text ends in the next
    one's beginning (see edited). A null text counts as empty. common_edited
    and common_next are the lengths of the common beginnings. An empty table
    gives no rows; other columns are ignored, whatever their names.

    Texts are shuffled once: a range's first row is sent along to the range
    before, so no task waits for another's rows, and each holds two texts at a time.
    """
    import hashlib

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RESULT.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        held: tuple | None = None  # part, doc_id, text, fingerprint
        for batch in batches:
            out: list[tuple] = []
            for part, guard, ident, body in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                own = held[3] if held and held[2] == body else Fingerprint(body, span, kept)
                if held and held[0] == part:
                    _, last_id, last, before = held
                    new = edited(last, body)
                    changed = before if new == last else Fingerprint(new, span, kept)
                    out.append((
                        last_id, before.n, hashlib.sha256(new.encode()).hexdigest(), before.text, changed.text, likeness(before, changed), likeness(before, own),
                        common_prefix(before.prefixes, changed.prefixes), common_prefix(before.prefixes, own.prefixes),
                    ))
                held = None if guard else (part, ident, body, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return with_next(docs, doc_id, text, part_bytes).mapInArrow(textops.light(work), RESULT)
