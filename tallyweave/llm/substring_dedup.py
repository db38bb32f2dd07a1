"""Removal of repeated word windows, found by difference-cover anchors.

Each document hashes short windows only where its word position, modulo a
period, lies in a difference cover: a set of residues whose differences give
every residue. For any two places in two documents some shift below the period
brings both onto cover positions, so two equal long windows share an aligned
anchor. Anchors that occur once in the corpus rule out most windows at once;
the rest extend to the whole window and are compared in full.
"""

from __future__ import annotations

from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm import shards, textops

#: Bits of a place in a shard, and of an anchor's key, which only rules windows out and may be shared by chance.
PLACE_BITS, KEY_BITS = 34, 48

RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>"


def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set of residues whose differences modulo period are all residues."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError(period)


def plan(window: int, anchor: int | None = None) -> tuple[int, int, tuple[int, ...]]:
    """Anchor length, period and cover: a window of the given words holds period consecutive anchors."""
    anchor = anchor or max(1, min(window, 8 if window >= 20 else window - min(window - 1, 6)))
    period = window - anchor + 1
    return anchor, period, difference_cover(period)


class Shard:
    """The words of a shard's documents and the hashes of their windows."""

    def __init__(self, table: pa.Table, window: int):
        self.table, self.window = table, window
        self.anchor, self.period, self.cover = plan(window)
        self.buf, self.offs = textops.batch(table["text"])
        self.starts, self.ends, self.first = textops.words(self.buf, self.offs)
        self.doc = np.repeat(np.arange(len(self.offs) - 1), np.diff(self.first))
        self.room = self.first[self.doc + 1] - np.arange(len(self.starts))  # words from here to the document's end

    @cached_property
    def codes(self) -> np.ndarray:
        return textops.word_codes(self.buf, self.starts, self.ends) if len(self.starts) else np.zeros(0, np.uint64)

    @cached_property
    def sums(self) -> textops.Sums:
        return textops.Sums(self.codes)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Word index of each anchor, and its hash."""
        if not len(self.starts):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at_cover = np.zeros(self.period, bool)
        at_cover[list(self.cover)] = True
        pos = np.arange(len(self.starts)) - self.first[self.doc]
        at = np.flatnonzero(at_cover[pos % self.period] & (self.room >= self.anchor))
        return at, self.sums.hash(at, at + self.anchor) >> np.uint64(64 - KEY_BITS)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Windows that hold an anchor which occurs elsewhere too."""
        at, keys = self.anchors()
        if not len(at):
            return at
        distinct, which, n = np.unique(keys, return_inverse=True, return_counts=True)
        again = (n > 1) | np.isin(distinct, shared, kind="sort")
        hit = np.zeros(len(self.starts) + 1, np.int32)
        hit[at[again[which]] + 1] = 1
        seen = np.cumsum(hit)
        i = np.flatnonzero(self.room >= self.window)
        return i[seen[i + self.period] > seen[i]]

    def distinct(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of windows in document order: a 64-bit and a 32-bit hash of each, its place, and whether it repeats an earlier one of the shard."""
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int32), at, np.zeros(0, bool)
        low = self.sums.hash(at, at + self.window)
        high = textops.Sums(textops.mix(self.codes ^ np.uint64(0x5851F42D4C957F2D)), 1).hash(at, at + self.window)
        order = np.lexsort((low, high))
        h, g, at = high[order], low[order], at[order]
        again = np.zeros(len(at), bool)
        again[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
        return h.view(np.int64), (g >> np.uint64(32)).astype(np.uint32).view(np.int32), at, again


def remove_repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """Drop each word of a window that also starts earlier in the corpus.

    Earlier means a smaller doc_id, or an earlier word of the same document;
    windows are judged on the input. A null, empty or blank text has no words;
    a null doc_id comes after all others; rows of equal or null doc_id come in
    an order that hashes of their texts give, and of equal rows the second
    repeats the first. An empty table gives an empty result; other columns are ignored. A
    text is read whole by one task, whose arrays take about 60 times its bytes.
    Windows are equal if 96 bits of two independent hashes of their words are,
    inside a shard 128.
    Returns doc_id, n_words, n_removed, kept_text (kept words joined by one
    space) and the removed word ranges.
    """
    parts, _ = shards.sharded(docs, doc_id, text)

    def anchors(table: pa.Table) -> pa.Table:
        keys = np.unique(Shard(table, window).anchors()[1]).view(np.int64)
        return pa.table({"key": keys, "shard": shards.me(table, len(keys))})

    def windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(table, window)
        high, low, at, again = shard.distinct(shard.candidates(answers["key"].to_numpy().view(np.uint64)))
        flags = np.zeros(len(shard.starts), bool)
        flags[at[again]] = True
        s, e = textops.runs(flags)  # windows that repeat in the shard need no answer
        order = np.argsort(at[~again], kind="stable")  # by place: neighbours share their document
        high, low, at = (x[~again][order] for x in (high, low, at))
        base = (table["shard"][0].as_py() if len(table) else 0) << PLACE_BITS
        known = np.arange(len(at) + 2 * len(s)) >= len(at)
        place = base + np.concatenate([at << 2, (s << 2) + 1, (e << 2) + 2])
        doc = shards.ids(np.concatenate([shard.doc[at], np.zeros(2 * len(s), np.int64)]), table) if len(place) else pa.nulls(0, pa.int64())
        spread = lambda x, kind: pa.array(np.concatenate([x, np.zeros(2 * len(s), x.dtype)]), kind, mask=known)
        return pa.table({"high": np.where(known, place, np.concatenate([high, np.zeros(2 * len(s), np.int64)])), "low": spread(low, pa.int32()), "doc_id": doc, "place": place})

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(table, window)
        mark = answers["mark"].to_numpy()
        single, s, e = (np.sort(mark[(mark & 3) == kind] >> 2) for kind in (0, 1, 2))
        s, e = np.concatenate([single, s]), np.concatenate([single + 1, e])
        return _kept(shard, textops.covered(s, e + window - 1, len(shard.starts)))

    found = shards.shared(shards.per_shard(parts, anchors, "key long, shard int"))
    # place holds the shard, the window's word, and whether it is one window (0) or begins (1) or ends (2) a range of known repeats
    candidates = shards.resume(parts, found, windows, "high long, low int, doc_id long, place long")
    earlier = Window.partitionBy("high", "low").orderBy(F.col("doc_id").asc_nulls_last(), "place")
    repeats = candidates.withColumn("_n", F.row_number().over(earlier)).where("_n > 1 or low is null")
    mark = F.col("place").bitwiseAND((1 << PLACE_BITS) - 1).alias("mark")
    return shards.resume(parts, repeats.select(F.shiftright("place", PLACE_BITS).cast("int").alias("shard"), mark), cut, RESULT)


def _kept(shard: Shard, gone: np.ndarray) -> pa.Table:
    """The kept words of each document, one space between two."""
    keep = np.flatnonzero(~gone)
    buf = np.append(shard.buf, np.uint8(0x20))
    mask = textops.covered(shard.starts[keep], shard.ends[keep], len(buf))
    doc = shard.doc[keep]
    gaps = shard.ends[keep[:-1]][doc[:-1] == doc[1:]]  # a kept word of the same document follows
    mask[gaps], buf[gaps] = True, 0x20
    ends = np.concatenate(([0], np.cumsum(mask)))
    kept = textops.strings(buf[mask], np.diff(ends[shard.offs]), True)
    n_words = np.diff(shard.first)
    n_gone = np.diff(np.concatenate(([0], np.cumsum(gone)))[shard.first])
    s, e = textops.runs(gone)
    spans = [[] for _ in range(len(n_words))]
    for i, j in zip(s.tolist(), e.tolist(), strict=True):
        while i < j:  # a run may go on into the next document
            d = int(shard.doc[i])
            stop = min(j, int(shard.first[d + 1]))
            spans[d].append({"start": i - int(shard.first[d]), "end": stop - int(shard.first[d])})
            i = stop
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table({"doc_id": shard.table["doc_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_gone, pa.int64()), "kept_text": kept, "removed": pa.array(spans, kind)})
