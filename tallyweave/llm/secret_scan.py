"""Secrets in text: three base patterns, and a battery of randomness tests.

Every long run of encoding signs is judged under the encoding that it may be:
hexadecimal and base 32 by their alphabets, base 64 if it has letters of both
cases and digits and isn't for the most part made of words, as identifiers,
paths and addresses are. UUIDs are names, and never secrets. Three tests against
a uniform source follow: chi squared over the alphabet, runs about the middle of
the alphabet, and serial correlation; Fisher's sum of the three says how unlike
a random string the run is. How often ordinary strings of that encoding, as long
or shorter, look as random gives the run's p-value: a fixed reference, of letter
strings and for hexadecimal of padded, repeated, ascending and dated numbers,
says so for a start, whatever the corpus's size, and the corpus's own long words
refine it. Benjamini and Hochberg's rule over all judged runs of the corpus then
bounds the share of false finds; a run whose sum alone says that it isn't
uniform is never taken.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import durable, textops

#: Base patterns, in the order in which ties at one start are listed. Fixed values.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
_HINTS = (b"passw", b"secret", b"token", b"api_key", b"apikey")

#: Shortest run that the battery judges, the length classes' lower ends, and the share of false finds allowed.
RUN_LENGTH, LENGTHS, FALSE_SHARE = 20, (20, 22, 24, 28, 32, 36, 40, 48, 64, 96, 128), 0.01
_ENCODINGS = (16, 32, 64)

#: Fisher's sum of three tests from which on a string isn't uniform, whatever others there are: one random string in a thousand is beyond.
NOT_UNIFORM = 23

#: The share of a run's signs in words, lower-case letters of which at least so many with a capital before them or three capitals stand together, above which it is made of words.
WORDY, WORD = 0.68, 3
_BINS = 128

#: How many of the corpus's words the reference counts for, the letter strings of each kind that it is made of, and
#: their letters' shares in thousandths, a to z, as in English. Fixed values.
REFERENCE_WORDS, REFERENCE_STRINGS = 100, 2_000
LETTER_SHARES = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 1, 20, 1)

_SPAN = "array<struct<start:int,end:int,kind:string>>"
FOUND = f"doc_id long, base {_SPAN}, runs array<struct<start:int,end:int,cell:int>>, cells array<int>, counts array<long>"


def _table(signs: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(signs.encode())] = True
    return t


_LOW, _UP, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_HEX = _table(_DIGITS + "abcdef")
_CODED = _table(_LOW + _UP + _DIGITS + "+/_-")
_VALUE64 = np.zeros(256, np.uint8)
for _i, _c in enumerate((_UP + _LOW + _DIGITS + "+/").encode()):
    _VALUE64[_c] = _i
_VALUE64[list(b"-_")] = (62, 63)
_VALUE16 = np.zeros(256, np.uint8)
for _i, _c in enumerate(b"0123456789abcdef"):
    _VALUE16[_c] = _i
_VALUE16[list(b"ABCDEF")] = range(10, 16)
_VALUE32 = np.zeros(256, np.uint8)
for _i, _c in enumerate((_UP + "234567").encode()):
    _VALUE32[_c] = _i
#: The alphabet of base 32 as the nine commonest letters, the other letters, and digits.
_GROUP32 = np.array([0 if c in "ETAOINSHR" else 1 if c in _UP else 2 for c in _UP + "234567"])
_CLASS = np.zeros(256, np.uint8)  # bits: lower, upper, digit, sign, beyond hex, beyond base 32
for _c in _CODED.nonzero()[0].tolist():
    s = chr(_c)
    _CLASS[_c] = (s in _LOW) | (s in _UP) << 1 | (s in _DIGITS) << 2 | (s in "+/_-") << 3 | (s not in "0123456789abcdefABCDEF") << 4 | (s not in _UP + "234567") << 5


def class_runs(buf: np.ndarray, offs: np.ndarray, table: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of a byte class inside one text, of at least so many bytes."""
    inside = table[buf]
    d = np.zeros(len(buf) + 1, bool)
    d[offs] = True
    starts = np.flatnonzero(inside & (d[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (d[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def _upper_tail(z: np.ndarray) -> np.ndarray:
    """P(Z > z) of a standard normal; fixed values of the usual rational form."""
    a = np.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    tail = np.exp(-a * a / 2) / np.sqrt(2 * np.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.clip(np.where(z > 0, tail, 1 - tail), 1e-12, 1)


def _chi_tail(chi: np.ndarray, dof: int) -> np.ndarray:
    return _upper_tail(((chi / dof) ** (1 / 3) - (1 - 2 / (9 * dof))) / np.sqrt(2 / (9 * dof)))


def battery(values: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Fisher's sum for consecutive strings of values below size: small for a uniform source."""
    m = len(lengths)
    if not m:
        return np.zeros(0)
    who = np.repeat(np.arange(m), lengths)
    n = lengths.astype(float)
    counts = np.bincount(who * size + values, minlength=m * size).reshape(m, size)
    chi = ((counts - n[:, None] / size) ** 2).sum(1) * size / n
    dof = size - 1
    p_chi = _chi_tail(chi, dof)
    if size == 32:  # so few strings' worth of signs tell words from codes better by groups; the smaller of both counts, twice
        parts = np.stack([counts[:, _GROUP32 == g].sum(1) for g in range(3)], 1)
        expected = n[:, None] * np.bincount(_GROUP32) / 32
        p_chi = np.minimum(1, 2 * np.minimum(p_chi, _chi_tail(((parts - expected) ** 2 / expected).sum(1), 2)))
    high = values >= size / 2
    same = who[1:] == who[:-1]
    changes = np.bincount(who[1:][same & (high[1:] != high[:-1])], minlength=m)
    p_runs = 2 * _upper_tail(np.abs(changes - (n - 1) / 2) / np.sqrt((n - 1) / 4))
    x = values - (size - 1) / 2
    prod = np.bincount(who[1:][same], weights=(x[1:] * x[:-1])[same], minlength=m)
    p_serial = 2 * _upper_tail(np.abs(prod) / np.sqrt(n - 1) / ((size * size - 1) / 12))
    return -2 * (np.log(p_chi) + np.log(np.clip(p_runs, 1e-12, 1)) + np.log(np.clip(p_serial, 1e-12, 1)))


def _cells(score: np.ndarray, lengths: np.ndarray, encoding: int) -> np.ndarray:
    """One number for encoding, length class and score."""
    bins = np.minimum(score, _BINS - 1).astype(np.int64)
    return (_ENCODINGS.index(encoding) * len(LENGTHS) + np.searchsorted(LENGTHS, lengths, side="right") - 1) * _BINS + bins


def _gather(buf: np.ndarray, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(n)))
    return buf[np.repeat(s - total[:-1], n) + np.arange(total[-1])]


def _in_words(chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many signs of each run stand in words (lower-case letters, the capital before them with them, or capitals alone) or part them."""
    kind = _CLASS[chars]
    lower, upper = (kind & 1) > 0, (kind & 2) > 0
    begins = np.zeros(len(chars), bool)
    begins[starts] = True
    before = np.concatenate(([False], lower[:-1]))
    after = np.concatenate((lower[1:], [False])) & ~np.concatenate((begins[1:], [False]))
    leads = upper & after  # a capital that a lower-case letter follows belongs to it
    alone = upper & ~leads
    edge = begins | leads | (lower & ~before & ~np.concatenate(([False], leads[:-1]))) | (alone & ~np.concatenate(([False], alone[:-1]))) | (~lower & ~upper)
    piece = np.cumsum(edge) - 1
    size = np.bincount(piece)[piece]
    return np.add.reduceat((((lower | upper) & (size >= WORD)) | ((kind & 8) > 0)).astype(np.int64), starts)


def _uuids(buf: np.ndarray, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which runs are of the form 8-4-4-4-12 in hexadecimal."""
    out = np.zeros(len(s), bool)
    some = np.flatnonzero(n == 36)
    if len(some):
        signs = buf[s[some][:, None] + np.arange(36)]
        hyphen = np.isin(np.arange(36), (8, 13, 18, 23))
        out[some] = (signs[:, hyphen] == 0x2D).all(1) & ((_CLASS[signs[:, ~hyphen]] & 16) == 0).all(1)
    return out


def judge(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each run that may be a secret, -1 for an ordinary one; and the cells of the long words in base 32 and base 64."""
    n = e - s
    cell = np.full(len(s), -1, np.int64)
    if not len(s):
        return cell, cell
    chars = _gather(buf, s, n)
    starts = np.cumsum(n) - n
    kinds = np.bitwise_or.reduceat(_CLASS[chars], starts)
    first = _CLASS[buf[s]]
    rest = np.bitwise_or.reduceat(np.where(np.arange(len(chars)) == np.repeat(starts, n), 0, _CLASS[chars]), starts)
    word = (((kinds & 0b1110) == 0) | (((rest & 0b1110) == 0) & ((first & 2) > 0))) | ((kinds & 0b1101) == 0)  # lower, Capital or UPPER
    word &= (kinds & 0b11) > 0
    hexed = ((kinds & 16) == 0) & ((kinds & 3) != 3) & ((kinds & 7) != 4)  # digits alone are numbers
    base32 = ((kinds & 32) == 0) & ((kinds & 16) > 0) & ~word
    base64 = ((kinds & 7) == 7) & (_in_words(chars, starts) <= WORDY * n) & ~_uuids(buf, s, n)
    for size, values, mine in ((16, _VALUE16, hexed), (32, _VALUE32, base32), (64, _VALUE64, base64)):
        if mine.any():
            cell[mine] = _cells(battery(values[_gather(buf, s[mine], n[mine])].astype(np.int64), n[mine], size), n[mine], size)
    word &= ~hexed
    null = []
    if word.any():
        letters = (_gather(buf, s[word], n[word]) | 0x20).astype(np.int64) - 97
        for size in (32, 64):
            null.append(_cells(battery(np.clip(letters, 0, 25), n[word], size), n[word], size))
    return cell, np.concatenate(null) if null else np.zeros(0, np.int64)


def _find_all(data: bytes, needle: bytes) -> Iterator[int]:
    at = data.find(needle)
    while at >= 0:
        yield at
        at = data.find(needle, at + 1)


def _scan(texts: pa.Array) -> tuple[list, list, np.ndarray]:
    """Of each text its base spans and judged runs, in code points; and the cells of ordinary words."""
    buf, offs = textops.batch(texts)
    base = [[] for _ in range(len(offs) - 1)]
    runs = [[] for _ in range(len(offs) - 1)]
    raw, low = buf.tobytes(), textops.lower_ascii(buf).tobytes()
    doc_of = lambda at: np.searchsorted(offs, at, side="right") - 1
    hs, he = class_runs(buf, offs, _HEX, HEX_LENGTH)
    cs, ce = class_runs(buf, offs, _CODED, RUN_LENGTH)
    cell, null = judge(buf, cs, ce)
    cs, ce, cell = cs[cell >= 0], ce[cell >= 0], cell[cell >= 0]
    for _ in range(2):  # padding belongs to the span, not to what is judged
        ends = offs[doc_of(cs) + 1]
        ce = ce + ((ce < ends) & (buf[np.minimum(ce, len(buf) - 1)] == 0x3D)) if len(ce) else ce
    hinted = {int(d) for hint in _HINTS for d in doc_of(np.fromiter(_find_all(low, hint), np.int64))}
    keyed = {int(d) for d in doc_of(np.fromiter(_find_all(raw, b"AKIA"), np.int64))}
    hex_docs, run_docs = doc_of(hs), doc_of(cs)
    for d in hinted | keyed:
        text = raw[offs[d] : offs[d + 1]].decode()
        if d in hinted:
            base[d] += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
        if d in keyed:
            base[d] += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    point = {int(d): np.concatenate(([0], np.cumsum((buf[offs[d] : offs[d + 1]] & 0xC0) != 0x80))) for d in np.union1d(hex_docs, run_docs)}
    for d, s, e in zip(hex_docs.tolist(), hs.tolist(), he.tolist(), strict=True):
        base[d].append((int(point[d][s - offs[d]]), int(point[d][e - offs[d]]), "hex"))
    for d, s, e, c in zip(run_docs.tolist(), cs.tolist(), ce.tolist(), cell.tolist(), strict=True):
        runs[d].append((int(point[d][s - offs[d]]), int(point[d][e - offs[d]]), c))
    for found in base:
        found.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    return base, runs, null


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """doc_id, base and random: the spans of each document, ends exclusive, in code points.

    base has the matches of the three patterns; random the runs that the battery
    takes for secrets outside of those. A null text is an empty one and has no
    spans; each row is scanned by itself, whether its doc_id is null or
    repeated, and a long text is scanned whole. An empty table gives an empty
    result, and columns other than id and text are ignored. The corpus-wide
    figures are counts in a fixed number of cells.
    """
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    run = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cell", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(_ENCODINGS) * len(LENGTHS) * _BINS, np.int64)
        names = ["doc_id", "base", "runs", "cells", "counts"]
        for batch in batches:
            for part in textops.slices(batch, 2 << 20):
                base, runs, null = _scan(part.column(1))
                total += np.bincount(null, minlength=len(total))
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([[dict(zip(("start", "end", "kind"), x, strict=True)) for x in b] for b in base], span), pa.array([[dict(zip(("start", "end", "cell"), x, strict=True)) for x in b] for b in runs], run), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64()))],
                    names=names,
                )
        used = np.flatnonzero(total)  # the words of this task, as one row
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, span), pa.nulls(1, run), pa.array([used.tolist()], pa.list_(pa.int32())), pa.array([total[used].tolist()], pa.list_(pa.int64()))], names=names)

    found = durable.checkpoint(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(textops.light(find), FOUND))
    words = found.where("cells is not null").select(F.explode(F.arrays_zip("cells", "counts")).alias("x")).groupBy(F.col("x.cells").alias("cell")).agg(F.sum("x.counts").alias("n"), F.lit(0).alias("kind"))
    judged = found.where("base is not null").select(F.explode("runs").alias("x")).groupBy(F.col("x.cell").alias("cell")).agg(F.count("*").alias("n"), F.lit(1).alias("kind"))
    accepted = accept(words.unionByName(judged).collect(), false_share)  # at most two rows a cell
    outside = F.filter("runs", lambda r: r["cell"].isin(accepted or [-1]) & ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return found.where("base is not null").select("doc_id", "base", F.transform(outside, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), F.lit("random").alias("kind"))).alias("random"))


def _numbers(draw: np.random.Generator, length: int) -> np.ndarray:
    """Hexadecimal strings that aren't random: padded with zeros, repeated, ascending, and dates followed by a counter."""
    m = REFERENCE_STRINGS // 4
    place, each = np.arange(length), np.arange(m)[:, None]
    padded = np.where(place < draw.integers(length // 2, length, (m, 1)), 0, draw.integers(0, 16, (m, length)))
    repeated = draw.integers(0, 16, (m, 8))[each, place % draw.integers(1, 9, (m, 1))]
    ascending = (draw.integers(0, 16, (m, 1)) + place * draw.choice([1, -1], (m, 1))) % 16
    dated = draw.integers(0, 10, (m, length))
    dated[:, :4] = 2, 0, 1, 9
    dated[:, 4:12] = draw.integers(0, 4, (m, 8))
    dated[:, 14 : length - 3] = 0
    return np.concatenate([padded, repeated, ascending, dated])


@functools.cache
def reference() -> np.ndarray:
    """By encoding, length class and score bin, how likely an ordinary string is to look as random.

    For base 32 and base 64 these are letters, which are independent and so
    look more random than words do; for hexadecimal see _numbers. Strings are as
    short as their class allows. The lower tail is that of a normal distribution
    fitted to the square roots of the scores.
    """
    draw = np.random.Generator(np.random.PCG64(1))
    share = np.array(LETTER_SHARES) / sum(LETTER_SHARES)
    p = np.ones((len(_ENCODINGS), len(LENGTHS), _BINS))
    for j, length in enumerate(LENGTHS):
        letters = draw.choice(26, (REFERENCE_STRINGS, length), p=share)
        for i, size in enumerate(_ENCODINGS):
            strings = _numbers(draw, length) if size == 16 else letters
            root = np.sqrt(battery(strings.ravel(), np.full(len(strings), length), size))
            p[i, j, :-1] = _upper_tail((root.mean() - np.sqrt(np.arange(1, _BINS))) / max(root.std(), 0.5))
    return p


def accept(counts: list, false_share: float) -> list[int]:
    """Cells whose runs count as secrets: the largest set by p-value whose expected share of words is below false_share."""
    size = len(_ENCODINGS) * len(LENGTHS) * _BINS
    null, seen = np.zeros(size), np.zeros(size)
    for r in counts:
        (seen if r["kind"] else null)[r["cell"]] += r["n"]
    shape = (len(_ENCODINGS), len(LENGTHS), _BINS)
    # words as long or shorter: a longer word shows its structure more clearly
    null = null.reshape(shape).cumsum(1)
    p = ((REFERENCE_WORDS * reference() + null.cumsum(2)) / (REFERENCE_WORDS + null.sum(2, keepdims=True))).ravel()
    tested = seen.sum()
    p[np.arange(size) % _BINS >= NOT_UNIFORM] = 2  # never
    order = np.argsort(p, kind="stable")
    found = seen[order].cumsum()
    good = np.flatnonzero((p[order] * tested <= false_share * found) & (found > 0))
    return [int(c) for c in order[: good[-1] + 1] if seen[c]] if len(good) else []
