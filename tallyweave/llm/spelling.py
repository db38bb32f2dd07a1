"""Spelling variants: each word's nearest commoner form, one edit away.

Two words differ by one inserted, deleted or replaced code point exactly if
their lengths differ by one at most and common prefix and common suffix
together reach the longer length m less one. One of the two then reaches half
of m, so near words share the half of m at either end, and only words that do
meet: as dense tiles, in which padded matrices of code points are compared
column by column from both ends. A half that many words share is dealt into
blocks, each pair of which is a tile of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import durable, textops

#: Latin letters, as the first and last code point of each range.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words in a block, code points in a block's matrix, and words up to which tiles of few words are joined to one.
BLOCK, POINTS, JOINED = 1_024, 1 << 22, 128

CELL = ("side", "m", "half", "i", "j")
LINKS = "word string, near string, near_n long"


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 6, least_count: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of the words of at least that length and count.

    Words are runs of LETTERS with A-Z in lower case; of a run whose crc32, of
    <doc_id>:<run>, is a multiple of `every`, the code point at that number
    modulo the length is deleted. A null id counts as empty, a null text holds
    no words.
    """
    run = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"({LETTERS})"), F.lit(1)))
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.where(F.length("run") >= least_length).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _codes(words: list[str], m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words of at most m, filled up to m on the right, and in reverse; and lengths."""
    points = np.array(words, f"<U{m}").view(np.uint32).reshape(-1, m)
    lengths = np.array([len(w) for w in words])
    back = np.array([w[::-1] for w in words], f"<U{m}").view(np.uint32).reshape(-1, m)
    if points.max(initial=0) < 256:
        points, back = points.astype(np.uint8), back.astype(np.uint8)
    return points, back, lengths


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of all pairs of rows, how many columns from the first are alike."""
    same = np.ones((len(a), len(b)), bool)
    out = np.zeros(same.shape, np.int32)
    for c in range(a.shape[1]):
        same &= a[:, c, None] == b[None, :, c]
        if not same.any():
            break
        out += same
    return out


def near_pairs(left: list[str], right: list[str], m: int, side: str, same: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of left and right words that are near and the longer of which has m code points.

    On the side of suffixes, pairs whose prefix reaches the half of m are left
    to the other side. same tells which pairs count at all.
    """
    (a, ra, la), (b, rb, lb) = _codes(left, m), _codes(right, m)
    prefix = _common(a, b)
    longest, apart = np.maximum(la[:, None], lb[None, :]), np.abs(la[:, None] - lb[None, :])
    near = (prefix + _common(ra, rb) >= m - 1) & (longest == m) & (apart <= 1)
    near &= ~((apart == 0) & (prefix == m))  # a word itself
    near &= (prefix < m // 2) if side == "s" else (prefix >= m // 2)
    return np.nonzero(near if same is None else near & same)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the cells that sorted rows (side, m, half, i, j, block, word, n) make up."""

    def links(left: pa.Table, right: pa.Table | None, m: int, side: str, groups: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        ours, theirs = left["word"].to_pylist(), (left if right is None else right)["word"].to_pylist()
        same = groups[:, None] == groups[None, :] if groups is not None else None
        x, y = near_pairs(ours, theirs, m, side, same)
        if right is None:
            x, y = x[x < y], y[x < y]
        if len(x):
            a, b = left.take(pa.array(x)), (left if right is None else right).take(pa.array(y))
            yield from pa.table({"word": a["word"], "near": b["word"], "near_n": b["n"]}).to_batches()
            yield from pa.table({"word": b["word"], "near": a["word"], "near_n": a["n"]}).to_batches()

    def cells(table: pa.Table) -> Iterator[tuple[int, int]]:
        new = np.zeros(table.num_rows, bool)
        for c in CELL:
            v = table[c].combine_chunks()
            new[1:] |= v[1:].equals(v[:-1]) is False and np.asarray(pa.compute.not_equal(v[1:], v[:-1]))
        edges = [0, *np.flatnonzero(new).tolist(), table.num_rows]
        return zip(edges[:-1], edges[1:], strict=True)

    def work(table: pa.Table, bounds: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        few: list[tuple[int, int]] = []
        sides, ms, i, j = (table[c].to_pylist() for c in ("side", "m", "i", "j"))

        def joined() -> Iterator[pa.RecordBatch]:
            if few:
                start, end = few[0][0], few[-1][1]
                yield from links(table.slice(start, end - start), None, ms[start], sides[start], np.repeat(np.arange(len(few)), [e - s for s, e in few]))
                few.clear()

        for s, e in bounds:
            if few and ((sides[s], ms[s]) != (sides[few[0][0]], ms[few[0][0]]) or e - few[0][0] > JOINED or few[-1][1] != s):
                yield from joined()
            if i[s] == j[s] and e - s <= JOINED and (e - s) * ms[s] <= POINTS:
                few.append((s, e))
                continue
            part = table.slice(s, e - s)
            if i[s] == j[s]:
                yield from links(part, None, ms[s], sides[s])
            else:
                own = pa.compute.equal(part["block"], i[s])
                yield from links(part.filter(own), part.filter(pa.compute.invert(own)), ms[s], sides[s])
        yield from joined()

    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        bounds = list(cells(held))
        if len(bounds) > 1:  # the last cell may go on in the next batch
            yield from work(held, bounds[:-1])
            held = held.slice(bounds[-1][0])
    if held is not None and held.num_rows:
        yield from work(held, list(cells(held)))


def links(table: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n): each word's near words, from a table of different words (word, n)."""
    length = F.length("word")
    keys = [F.struct(F.lit(side).alias("side"), m.cast("int").alias("m"), (F.left if side == "p" else F.right)(F.col("word"), (m / 2).cast("int")).alias("half")) for side in "ps" for m in (length, length + 1)]
    rows = table.select("word", "n", F.explode(F.array(*keys)).alias("k")).select("word", "n", "k.side", "k.m", "k.half")
    sizes = rows.groupBy(*CELL[:3]).agg(F.count("*").alias("size")).where("size > 1")
    most = F.greatest(F.lit(2), F.least(F.lit(block), (F.lit(POINTS) / F.col("m")).cast("int")))
    dealt = rows.join(sizes.withColumn("blocks", F.ceil(F.col("size") / most).cast("int")).drop("size"), list(CELL[:3]))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("word", "n", *CELL[:3], F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block")
    return dealt.repartition(*CELL).sortWithinPartitions(*CELL, "block").mapInArrow(textops.light(_tiles), LINKS)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form, the last that is reached from form to form.

    Each round doubles how far a word has got. As forms are commoner than their
    words by a factor, no chain is longer than the logarithm of the greatest count.
    """
    reached = durable.rewritten(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = durable.rewritten(reached.join(on, "root", "left"), "roots")
        if not further.where("_next is not null").take(1):
            return reached
        reached = further.select("word", F.coalesce("_next", "root").alias("root"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 6, least_count: int = 5, every: int = 199, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word (see words).

    A word's form is its near word of largest n, ties to the smallest in
    code-point order, if that n is at least `times` its own, else null; its
    root is the last form that is reached, or itself. Repeated rows count as
    often as they are there; an empty table gives no words; other columns are
    ignored, whatever their names.
    """
    table = durable.rewritten(words(docs, doc_id, text, least_length, least_count, every), "words")
    best = links(table).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("b"))
    found = table.join(best, "word", "left").withColumn("_known", F.coalesce(-F.col("b.less") >= times * F.col("n"), F.lit(False)))
    when = lambda c: F.when(F.col("_known"), c)
    found = durable.rewritten(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), when(F.col("b.near")).alias("form"), when(-F.col("b.less")).alias("form_n")), "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
