"""Benchmark passages in documents, by q-gram counts in diagonal bands.

A copy of an item with at most k edits keeps all but k * q of the item's
q-grams, and these lie within k diagonals of each other. The same holds for
every window of a fixed length of a longer item, so that a part of an item is
found too.

Both sides are tables. A bitmap of fixed size, of all benchmark q-grams, and
the lemma's count cut the documents down to stretches that may hold a passage;
the q-grams of those are joined with the benchmark's, and counted for each
stretch, item and overlapping band of diagonals. Only pairs that reach the
count get their texts, and are aligned in a band.

In periodic text, a rule of dashes for one, a q-gram comes again at once and
all along. Such a run is one row with its number, runs meet as runs, and what
their q-grams add to each diagonal follows from both numbers; so the work grows
with lengths and not with their product. Stretches that are equal are looked at once a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import durable, textops

#: Length of a q-gram in bytes, and edits allowed for each byte of an item.
GRAM, EDIT_SHARE = 10, 0.08

#: Bytes of an item's windows that the queries look for besides whole items.
WINDOW = 100

#: Bits of the benchmark's bitmap (2 MB); with more q-grams than it can tell apart it lets more stretches pass, and the result stays.
FILTER_BITS = 24

#: Least bytes of a stretch; longer ones are cut, with overlap.
STRETCH = 4_096

#: Windows that are aligned at a time, and neighbouring ones whose common part is aligned first.
WINDOW_ROWS, WINDOW_BLOCK = 2_048, 16

#: Places in bands that are counted at a time, those of one pair always together.
BAND_ROWS = 2_000_000

RESULT = "doc_id long, item_id long, start int, end int, edits int"

_STRETCHES = "stretch long, doc_id long, digest binary, start int, core_from int, core_to int, body binary, same long, codes array<long>, places array<int>, run_codes array<long>, run_places array<int>, counts array<int>, steps array<int>, short_at array<int>, short_text array<binary>"
_STRETCH = pa.schema([
    ("stretch", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("start", pa.int32()), ("core_from", pa.int32()), ("core_to", pa.int32()), ("body", pa.binary()), ("same", pa.int64()),
    ("codes", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("run_codes", pa.list_(pa.int64())), ("run_places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("steps", pa.list_(pa.int32())), ("short_at", pa.list_(pa.int32())), ("short_text", pa.list_(pa.binary())),
])

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def normalise(buf: np.ndarray) -> np.ndarray:
    """A-Z in lower case and every white space as a space; places stay."""
    table = np.arange(256, dtype=np.uint8)
    table[textops.SPACES] = 0x20
    return textops.lower_ascii(table[buf])


def gram_codes(buf: np.ndarray, q: int) -> np.ndarray:
    n = len(buf) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    i = np.arange(n)
    return textops.byte_sums(buf).hash(i, i + q)


def _short_code(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _owner(offs: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


def _grams_inside(buf: np.ndarray, offs: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, text and place of each q-gram that lies in one text."""
    codes, owner = gram_codes(buf, q), _owner(offs)
    at = np.flatnonzero(owner[: len(codes)] == owner[q - 1 :]) if len(codes) else np.zeros(0, np.int64)
    return codes[at], owner[at], at


def _runs(codes: np.ndarray, at: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code, first place, number and step of the runs that equal q-grams make which come again within q bytes, always after the same step; sorted by code.

    Where a q-gram overlaps itself it has a period, and all that overlap so
    follow each other by the least one: a run's step is the same in every text.
    """
    order = np.lexsort((at, codes))
    codes, at = codes[order], at[order]
    gap = np.diff(at, prepend=at[:1])
    far = np.ones(len(at), bool)
    far[1:] = (codes[1:] != codes[:-1]) | (gap[1:] >= q)
    new = far.copy()
    new[1:] |= (gap[1:] != gap[:-1]) & ~far[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    step = np.where(count > 1, gap[np.minimum(first + 1, max(len(at) - 1, 0))], 0) if len(at) else gap
    return codes[first], at[first], count, step


def _budget(size: Column, q: int, share: float) -> Column:
    """Edits that an item of so many bytes allows; at least one q-gram stays whole."""
    return F.least(F.floor(size * share), F.floor((size - q) / q)).cast("int")


class Benchmark:
    """The items as tables, and what of them has a fixed size: bitmap, size classes and lengths of short items."""

    def __init__(self, benchmark: DataFrame, item_id: str, text: str, q: int, share: float, window: int | None):
        self.q, self.share = q, share
        self.window = max(window, q) if window else None
        if self.window:
            self.window_budget = min(int(share * self.window), (self.window - q) // q)
            self.window_least = self.window - q + 1 - self.window_budget * q

        def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = [normalise(np.frombuffer((t or "").encode(), np.uint8)).tobytes().strip(b" ") for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary())], names=["item_id", "item_body"])

        rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("item_text")).where("item_text is not null").mapInArrow(bodies, "item_id long, item_body binary")
        size = F.octet_length("item_body")
        items = durable.checkpoint(rows.where(size > 0).withColumn("item", F.monotonically_increasing_id()).withColumn("size", size))
        self.short = items.where(F.col("size") < q).select("item", "item_id", "item_body")
        self.items = items.where(F.col("size") >= q).withColumn("budget", _budget(F.col("size"), q, share)).withColumn("least", F.col("size") - q + 1 - F.col("budget") * q)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in textops.slices(batch):
                    buf, offs = textops.batch(b.column(1))
                    items = b.column(0).to_numpy(zero_copy_only=False)
                    codes, owner, at = _grams_inside(buf, offs, q)
                    for i, (x, y) in enumerate(zip(*(np.searchsorted(owner, np.arange(b.num_rows), side=k) for k in ("left", "right")), strict=True)):
                        code, pos, n, step = _runs(codes[x:y], at[x:y] - offs[i], q)
                        if len(code):
                            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(np.full(len(code), items[i])), *(pa.array(c.astype(np.int32)) for c in (pos, n, step))], names=["code", "item", "pos", "m", "own_step"])

        grams = self.items.select("item", "item_body").mapInArrow(cut, "code long, item long, pos int, m int, own_step int")
        need = F.col("least")
        if self.window:
            need = F.when(F.col("size") > self.window, F.least("least", F.lit(self.window_least))).otherwise(need)
        self.grams = grams.join(self.items.select("item", "size", (F.col("budget") + 1).alias("half"), need.alias("need")), "item")

        def short_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                buf, offs = textops.batch(b.column(0))
                yield pa.RecordBatch.from_arrays([pa.array(textops.byte_sums(buf).hash(offs[:-1], offs[1:]).view(np.int64))], names=["code"])

        codes = grams.select("code").unionByName(self.short.select("item_body").mapInArrow(short_codes, "code long"))
        place = F.shiftrightunsigned("code", 64 - FILTER_BITS)
        marks = codes.select(place.alias("place")).groupBy(F.expr("place div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits")).collect()  # at most 2**FILTER_BITS / 64 rows
        self.filter = np.zeros(1 << FILTER_BITS >> 6, np.uint64)
        for r in marks:
            self.filter[r["at"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF
        # four size classes an octave: a match of an item has `least` q-grams within its size and budget
        octave = F.floor(F.log2(F.col("size").cast("double")) * 4)
        classes = self.items.groupBy(octave.alias("octave")).agg(F.max(F.col("size") + F.col("budget")).alias("most"), F.min("least").alias("need")).collect()  # at most 124 rows
        self.kinds = [(r["most"], max(1, r["need"])) for r in classes]
        self.margin = 2 * max((m for m, _ in self.kinds), default=0)
        self.core = max(STRETCH, 2 * self.margin)
        if self.window and classes and max(m for m, _ in self.kinds) > self.window:
            self.kinds.append((self.window + self.window_budget, self.window_least))
        self.short_lengths = sorted(r[0] for r in self.short.select(F.octet_length("item_body")).distinct().collect())  # below q


def dense(at: np.ndarray, doc: np.ndarray, kinds: list[tuple[int, int]]) -> np.ndarray:
    """Which of the ascending places lie among `need` within `most` bytes of one document, for some kind (most, need)."""
    keep = np.zeros(len(at), bool)
    for most, need in kinds:
        lead = np.arange(max(0, len(at) - need + 1))
        full = lead[(at[lead + need - 1] - at[lead] < most) & (doc[lead + need - 1] == doc[lead])]
        keep |= textops.covered(full, full + need, len(at))
    return keep


def _stretches(ids: list, raw: np.ndarray, offs: np.ndarray, bench: tuple, number: int, seen: dict[bytes, int]) -> list[tuple]:
    """Rows of the stretches of a batch that may hold a passage, numbered from a given number.

    same is the number of the first stretch like it, in text and core, that
    this task has seen; only that one's row has text and q-grams.
    """
    q, bits, kinds, margin, core, short_lengths = bench
    buf = normalise(raw)
    found: dict[int, list] = {}
    if kinds:
        codes = gram_codes(buf, q)
        at = np.flatnonzero(bits[_short_code(codes)])
        doc = np.searchsorted(offs, at, side="right") - 1
        inside = at + q <= offs[doc + 1]
        at, doc = at[inside], doc[inside]
        keep = dense(at, doc, kinds)
        at, doc = at[keep], doc[keep]
        lo, hi = np.maximum(at - margin, offs[doc]), np.minimum(at + q + margin, offs[doc + 1])
        new = np.ones(len(at), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at))[: len(first)] - 1
        for d, s, e in zip(doc[first].tolist(), lo[first].tolist(), hi[last].tolist(), strict=True):
            for c in range(s, e, core):
                b, f = max(int(offs[d]), s, c - margin), min(int(offs[d + 1]), e, c + core + margin)
                x, y = np.searchsorted(at, (b, f - q + 1))
                if x < y:
                    found.setdefault(d, []).append((b, c, min(e, c + core), buf[b:f].tobytes(), codes[at[x:y]], at[x:y] - b))
    shorts: dict[int, list] = {}
    if short_lengths:
        solid = _WORD[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[offs] = True
        begins = np.ones(len(buf) + 1, bool)  # no letter or digit goes before, or none follows
        begins[1:-1] = ~(solid[1:] & solid[:-1]) if len(buf) else begins[1:-1]
        begins |= edge
        sums = textops.byte_sums(buf)
        for n in short_lengths:
            at = np.flatnonzero(begins[: max(0, len(buf) - n + 1)])
            at = at[begins[at + n]]
            doc = np.searchsorted(offs, at, side="right") - 1
            at = at[at + n <= offs[doc + 1]]
            at = at[bits[_short_code(sums.hash(at, at + n))]]
            for x, d in zip(at.tolist(), (np.searchsorted(offs, at, side="right") - 1).tolist(), strict=True):
                shorts.setdefault(d, []).append((x - int(offs[d]), buf[x : x + n].tobytes()))
    rows = []
    for d in sorted({*found, *shorts}):
        o = int(offs[d])
        digest = hashlib.md5(raw[o : offs[d + 1]].tobytes()).digest()
        for b, c, f, body, codes, at in found.get(d, []):
            key = hashlib.blake2b(body, digest_size=16, key=b"%d %d" % (c - b, f - b)).digest()
            own = number + len(rows)
            same = seen.setdefault(key, own)
            if same != own:
                rows.append((own, ids[d], digest, b - o, c - o, f - o, None, same, *[None] * 8))
                continue
            code, place, n, step = _runs(codes, at, q)
            code, place, n, step = code.view(np.int64), place.astype(np.int32), n.astype(np.int32), step.astype(np.int32)
            one = n == 1
            rows.append((own, ids[d], digest, b - o, c - o, f - o, body, same, code[one], place[one], code[~one], place[~one], n[~one], step[~one], None, None))
        if d in shorts:
            rows.append((number + len(rows), ids[d], digest, 0, 0, 0, *[None] * 8, *zip(*shorts[d], strict=True)))
    return rows


def align(item: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """The fewest edits between the item and a part of the region, with the part's bounds; None beyond most.

    The edit table is computed by rows, on the diagonals that any part of the
    region within most edits can use; inside a row, running least values carry
    insertions along.
    """
    at = region.tobytes().find(item.tobytes())
    if at >= 0:
        return at, at + len(item), 0

    def last_row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Edits between a and the parts of b that end at each place, most + 1 for more."""
        width = max(1, len(b) - len(a) + 2 * most + 1)
        steps = np.arange(width)
        far = most + 1
        padded = np.concatenate([np.full(most + 1, -1), b.astype(np.int64), np.full(width + len(a) + most + 1, -1)])
        place = steps - most  # column of each diagonal in row 0
        row = np.where((place >= 0) & (place <= len(b)), 0, far)
        for i, c in enumerate(a.tolist()):
            place = place + 1
            new = row + (padded[i + 1 : i + 1 + width] != c)
            new[:-1] = np.minimum(new[:-1], row[1:] + 1)
            new[(place < 0) | (place > len(b))] = far
            row = np.minimum(np.minimum.accumulate(new - steps) + steps, far)
            row[(place < 0) | (place > len(b))] = far
            if row.min() >= far:
                break
        out = np.full(len(b) + 1, far)
        good = (place >= 0) & (place <= len(b))
        out[place[good]] = row[good]
        return out

    row = last_row(item, region)
    end = int(row.argmin())
    edits = int(row[end])
    if edits > most:
        return None
    back = last_row(item[::-1], region[:end][::-1])
    return end - int(np.flatnonzero(back == edits)[0]), end, edits


class Pairs:
    """Stretches and items side by side, their shared q-grams, and the passages that alignment confirms."""

    def __init__(self, texts: pa.Array, items: pa.Array, q: int, share: float, window: tuple[int, int, int] | None):
        self.q, self.window = q, window
        self.buf, self.offs = textops.batch(texts)
        self.items, self.item_offs = textops.batch(items)
        self.size = np.diff(self.item_offs)
        self.budget = np.minimum((share * self.size).astype(np.int64), (self.size - q) // q)
        self.least = self.size - q + 1 - self.budget * q
        self._share_grams()

    def _share_grams(self) -> None:
        """pair, place in the item, and first and last place in the stretch of the runs of each q-gram that both have."""
        salt = lambda codes, pair: textops.mix(codes ^ textops.mix(pair.astype(np.uint64) + np.uint64(1)))
        codes, pair, at = _grams_inside(self.buf, self.offs, self.q)
        own, of, pos = _grams_inside(self.items, self.item_offs, self.q)
        # places of one pair lie within one text, so runs don't go on from pair to pair
        own, pos, m, own_step = _runs(salt(own, of), pos, self.q)
        codes, at, n, step = _runs(salt(codes, pair), at, self.q)
        left, right = (np.searchsorted(own, codes, side=k) for k in ("left", "right"))
        k = right - left  # runs of the item with this code
        which = np.repeat(left, k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        at, n, step = (np.repeat(x, k) for x in (at, n, step))
        m, pos, own_step = m[which], pos[which], own_step[which]
        inside = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        pos, at, last = np.repeat(pos, m) + np.repeat(own_step, m) * inside, np.repeat(at, m), np.repeat(at + step * (n - 1), m)
        pair = np.searchsorted(self.item_offs, pos, side="right") - 1
        order = np.argsort(pair, kind="stable")
        self.pair = pair[order]
        self.pos = pos[order] - self.item_offs[self.pair]
        self.first, self.last = at[order] - self.offs[self.pair], last[order] - self.offs[self.pair]

    def _bands(self, half: np.ndarray, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Different (pair and band, place in the item) of some entries, sorted, for a few pairs at a time.

        Each diagonal lies in two bands of twice half, and any budget of
        diagonals in one. A run of places touches all bands from its first to
        its last diagonal; those in between that a long step passes over are
        taken along, which alignment sorts out.
        """
        size = self.size[self.pair]
        low, high = ((x - self.pos + size) // half for x in (self.first, self.last))  # never below zero
        n = np.where(some, high - low + 2, 0)
        each = np.bincount(self.pair, weights=n, minlength=len(self.size)).cumsum()
        chunk = (each // BAND_ROWS).astype(np.int64)[self.pair]
        for c in np.unique(chunk):
            x = np.flatnonzero((chunk == c) & some)
            k = n[x]
            band = np.repeat(low[x], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)  # low to high + 1, for shifts of one and none
            key, pos = np.repeat(self.pair[x], k) * (1 << 32) + band, np.repeat(self.pos[x], k)
            order = np.lexsort((pos, key))
            key, pos = key[order], pos[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (pos[1:] != pos[:-1])
            yield key[new], pos[new]

    def item(self, p: int) -> np.ndarray:
        return self.items[self.item_offs[p] : self.item_offs[p + 1]]

    def text(self, p: int) -> np.ndarray:
        return self.buf[self.offs[p] : self.offs[p + 1]]

    def passages(self) -> list[tuple[int, int, int, int]]:
        """(pair, start, end, edits) of whole items and, with a window, of parts, in bytes of the stretch."""
        bands: dict[int, list[int]] = {}
        for key, _ in self._bands(self.budget[self.pair] + 1, np.ones(len(self.pair), bool)):
            key, count = np.unique(key, return_counts=True)
            good = count >= self.least[key >> 32]
            for p, b in zip((key[good] >> 32).tolist(), (key[good] & 0xFFFFFFFF).tolist(), strict=True):
                bands.setdefault(p, []).append(b - 1)
        found = []
        for p, those in bands.items():
            k, size, text = int(self.budget[p]), int(self.size[p]), self.text(p)
            done = -1
            for g in np.split(np.array(those), np.flatnonzero(np.diff(those) > 1) + 1):
                lo = max(0, int(g[0]) * (k + 1) - size - k, done)
                hi = min(len(text), (int(g[-1]) + 2) * (k + 1) + k)
                while (hit := align(self.item(p), text[lo:hi], k)) is not None:
                    found.append((p, lo + hit[0], lo + hit[1], hit[2]))
                    done = lo = lo + max(hit[1], 1)  # a copy further on in the same bands
                    if hi - lo < size - k:
                        break
        return found + (self._parts(found) if self.window else [])

    def _candidates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """pair, band and start of each window of a long item that reaches the count in a band."""
        k = self.window[1]
        made = [self._windows(key, pos) for key, pos in self._bands(np.full(len(self.pair), k + 1), self.size[self.pair] > self.window[0])]
        return tuple(np.concatenate([m[i] for m in made] or [np.zeros(0, np.int64)]) for i in range(3))

    def _windows(self, key: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        length, _, need = self.window
        lead = np.arange(max(0, len(key) - need + 1))
        lead = lead[(key[lead + need - 1] == key[lead]) & (pos[lead + need - 1] - pos[lead] <= length - self.q)]
        first = np.maximum(pos[lead + need - 1] + self.q - length, 0)
        stop = np.minimum(pos[lead], self.size[key[lead] >> 32] - length) + 1
        key, first, stop = key[lead][stop > first], first[stop > first], stop[stop > first]
        # starts of one band as disjoint runs: both bounds ascend with lead
        same = np.zeros(len(key), bool)
        same[1:] = key[1:] == key[:-1]
        first[1:] = np.where(same[1:], np.maximum(first[1:], stop[:-1]), first[1:])
        n = np.maximum(stop - first, 0)
        total = np.concatenate(([0], np.cumsum(n)))
        start = np.repeat(first - total[:-1], n) + np.arange(total[-1])
        key = np.repeat(key, n)
        return key >> 32, (key & 0xFFFFFFFF) - 1, start

    def _align_many(self, pair: np.ndarray, start: np.ndarray, stop: np.ndarray, lo: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each item part [start, stop), all of one length, the fewest edits to a part of [lo, lo + reach) of its stretch, and that part's bounds."""
        at = (self.item_offs[pair] + start)[:, None] + np.arange(int(stop[0] - start[0]))
        place = (self.offs[pair] + lo)[:, None] + np.arange(reach)
        inside = (place >= self.offs[pair][:, None]) & (place < self.offs[pair + 1][:, None])
        regions = np.where(inside, self.buf[np.clip(place, 0, len(self.buf) - 1)], 0xFF)  # a byte that no text has
        # in periodic text most windows and regions are alike: equal ones are aligned once
        both = np.ascontiguousarray(np.hstack([self.items[at], regions]))
        _, first, which = np.unique(both.view(f"V{both.shape[1]}").ravel(), return_index=True, return_inverse=True)
        return tuple(x[which] for x in _align_rows(self.items[at[first]], regions[first]))

    def _parts(self, whole: list) -> list[tuple[int, int, int, int]]:
        """Each stretch of overlapping windows that is not in a whole passage."""
        length, k, _ = self.window
        half = k + 1
        pair, band, start = self._candidates()
        known: dict[int, list[tuple[int, int]]] = {}
        for p, s, e, _ in whole:
            known.setdefault(p, []).append((s, e))
        lo = start + band * half - self.size[pair] - k  # where the window's region begins
        keep = np.ones(len(pair), bool)
        for p, spans in known.items():
            a, b = np.searchsorted(pair, (p, p + 1))
            for s, e in spans:
                keep[a:b] &= ~((lo[a:b] + k + half >= s - half) & (lo[a:b] + k + half + length <= e + half))
        pair, band, start, lo = (x[keep] for x in (pair, band, start, lo))
        keep = self._blocks(pair, band, start, lo)
        pair, start, lo = (x[keep] for x in (pair, start, lo))
        hits: dict[int, list[tuple[int, int, int]]] = {}
        for a in range(0, len(pair), WINDOW_ROWS):
            part = slice(a, a + WINDOW_ROWS)
            edits, s, e = self._align_many(pair[part], start[part], start[part] + length, lo[part], length + 2 * half + 2 * k)
            for x in np.flatnonzero(edits <= k).tolist():
                p = int(pair[a + x])
                n = int(self.offs[p + 1] - self.offs[p])
                s_, e_ = (min(max(int(lo[a + x] + v[x]), 0), n) for v in (s, e))
                hits.setdefault(p, []).append((s_, e_, int(start[a + x])))
        found = []
        for p, spans in hits.items():
            groups: list[list[int]] = []
            for s_, e_, w in sorted(spans):
                if groups and s_ < groups[-1][1]:
                    g = groups[-1]
                    g[1], g[2], g[3] = max(g[1], e_), min(g[2], w), max(g[3], w)
                else:
                    groups.append([s_, e_, w, w])
            for s_, e_, w, v in groups:
                if any(x - half <= s_ and e_ <= y + half for x, y in known.get(p, [])):
                    continue
                got, g, h = align(self.item(p)[w : v + length], self.text(p)[s_:e_], int(self.size[p]))
                found.append((p, s_ + got, s_ + g, h))
        return found

    def _blocks(self, pair: np.ndarray, band: np.ndarray, start: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Windows left when runs of WINDOW_BLOCK neighbours go whose common part is already beyond the budget."""
        length, k, _ = self.window
        block = start // WINDOW_BLOCK
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (band[1:] != band[:-1]) | (block[1:] != block[:-1])
        if len(pair) == 0 or length <= WINDOW_BLOCK:
            return np.ones(len(pair), bool)
        first = np.flatnonzero(new)
        # all windows that start in one block of places hold these bytes
        core = block[first] * WINDOW_BLOCK + WINDOW_BLOCK - 1
        stop = block[first] * WINDOW_BLOCK + length
        region = lo[first] - start[first] + block[first] * WINDOW_BLOCK
        reach = length + WINDOW_BLOCK + 2 * (k + 1) + 2 * k
        good = np.ones(len(first), bool)
        for a in range(0, len(first), WINDOW_ROWS):
            part = slice(a, a + WINDOW_ROWS)
            good[part] = self._align_many(pair[first[part]], core[part], stop[part], region[part], reach)[0] <= k
        return good[np.cumsum(new) - 1]


def _align_rows(windows: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window the fewest edits to a part of its region, and that part's bounds, many windows at a time."""
    steps = np.arange(regions.shape[1] + 1, dtype=np.int32)
    one = np.int32(1 << 15)  # an edit; the part's start is taken off, so that it is carried along
    row = np.tile(-steps, (len(windows), 1))
    for i in range(windows.shape[1]):
        new = row + one
        np.minimum(new[:, 1:], row[:, :-1] + one * (regions != windows[:, i : i + 1]), out=new[:, 1:])
        row = np.minimum.accumulate(new - steps * one, axis=1) + steps * one
    end = row.argmin(1)
    best = row[np.arange(len(row)), end]
    edits = -(-best // one)
    return edits, edits * one - best, end


def _found(docs: DataFrame, benchmark: DataFrame, doc_id: Column, text: str, item_id: str, item_text: str, q: int, edit_share: float, window: int | None) -> DataFrame:
    """doc_id, digest of the text, item_id, start, end and edits of each passage."""
    bench = Benchmark(benchmark, item_id, item_text, q, edit_share, window)
    packed, state = bench.filter, (bench.kinds, bench.margin, bench.core, bench.short_lengths)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        seen: dict[bytes, int] = {}
        known = (q, np.unpackbits(packed.view(np.uint8), bitorder="little").view(bool), *state)
        for batch in batches:
            for b in textops.slices(batch):
                rows = _stretches(b.column(0).to_pylist(), *textops.batch(b.column(1)), known, number, seen)
                number += len(rows)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _STRETCH, strict=True)], schema=_STRETCH)

    stretches = durable.checkpoint(docs.select(doc_id.cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(textops.light(look), _STRETCHES))
    places = stretches.where("same is not null").select("same", "doc_id", "digest", "start")
    one = F.transform(F.arrays_zip("codes", "places"), lambda h: F.struct(h["codes"].alias("code"), h["places"].alias("place"), F.lit(1).alias("n"), F.lit(0).alias("step")))
    run = F.transform(F.arrays_zip("run_codes", "run_places", "counts", "steps"), lambda h: F.struct(h["run_codes"].alias("code"), h["run_places"].alias("place"), h["counts"].alias("n"), h["steps"].alias("step")))
    hits = stretches.where("codes is not null").select("stretch", F.explode(F.concat(one, run)).alias("h")).select("stretch", "h.*")
    # of runs of n and m equal q-grams, so many pairs are t steps apart
    apart = F.explode(F.sequence(1 - F.col("m"), F.col("n") - 1)).alias("t")
    met = hits.join(bench.grams, "code").select("stretch", "item", "need", "half", "n", "m", (F.col("place") - F.col("pos") + F.col("size")).alias("d"), F.greatest("step", "own_step").alias("step"), apart)
    many = F.least(F.col("n") - 1, F.col("m") - 1 + F.col("t")) - F.greatest(F.lit(0), F.col("t")) + 1
    band = F.floor((F.col("d") + F.col("step") * F.col("t")) / F.col("half")).cast("int")
    counted = met.select("stretch", "item", "need", many.alias("many"), F.explode(F.array(band, band - 1)).alias("band")).groupBy("stretch", "item", "band").agg(F.sum("many").alias("n"), F.first("need").alias("need"))
    pairs = counted.where("n >= need").select("stretch", "item").distinct()
    texts = pairs.join(stretches.select("stretch", "same", "start", "core_from", "core_to", "body"), "stretch").join(bench.items.select("item", "item_id", "item_body"), "item")
    limits = (bench.window, bench.window_budget, bench.window_least) if bench.window else None
    keep = ["same", "item_id"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in textops.slices(batch, 1 << 19):
                start, lo, hi = (b.column(c).to_numpy() for c in ("start", "core_from", "core_to"))
                found = Pairs(b.column("body"), b.column("item_body"), q, edit_share, limits).passages()
                # what begins in a stretch's overlap is its neighbour's
                found = [(p, s, e, x) for p, s, e, x in found if lo[p] <= start[p] + s < hi[p]]
                if found:
                    p, s, e, x = (pa.array(c, pa.int32()) for c in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([*(b.column(c).take(p) for c in keep), s, e, x], names=["same", "item_id", "from", "to", "edits"])

    kinds = "same long, item_id long, from int, to int, edits int"
    found = texts.select(*keep, "start", "core_from", "core_to", "body", "item_body").mapInArrow(textops.light(verify), kinds)
    found = found.join(places, "same").select("doc_id", "digest", "item_id", (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to")).alias("end"), "edits")
    keep = ["doc_id", "digest", "item_id"]
    if not bench.short_lengths:
        return found
    words = stretches.where("short_at is not null").select("doc_id", "digest", F.explode(F.arrays_zip("short_at", "short_text")).alias("h"))
    words = words.select("doc_id", "digest", F.col("h.short_at").alias("start"), F.col("h.short_text").alias("item_body"))
    exact = words.join(bench.short, "item_body").select(*keep, "start", (F.col("start") + F.octet_length("item_body")).alias("end"), F.lit(0).alias("edits"))
    return found.unionByName(exact)


def passages(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", q: int = GRAM, edit_share: float = EDIT_SHARE, window: int | None = None) -> DataFrame:
    """doc_id, item_id, start, end (bytes of the text, end exclusive) and edits of each benchmark passage.

    Case and kinds of white space don't count as edits. An item allows
    edit_share edits a byte, fewer where that would leave no q-gram whole.
    Items shorter than a q-gram are found as they are, where no letter or digit
    stands next to them; blank or null items are not looked for. With a window,
    parts of longer items count too: each stretch of a text made of overlapping
    windows of so many bytes, every one within edit_share edits a byte of an
    item's, is a passage unless it lies in one of the whole item.

    A null or empty text has no passages. Every row counts by itself: repeated
    documents or items, with equal or null ids, give repeated rows. Either
    table may be empty, which gives no rows; columns other than the named ones
    are ignored, whatever their names. A long text is cut into overlapping
    stretches, so none is held whole with its q-grams.
    """
    return _found(docs, benchmark, F.col(doc_id), text, item_id, item_text, q, edit_share, window).select("doc_id", "item_id", "start", "end", "edits")


def without_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", q: int = GRAM, edit_share: float = EDIT_SHARE, window: int | None = None) -> DataFrame:
    """The rows, with all their columns, whose text holds no benchmark passage; the same rules as in passages().

    Rows are told apart by their texts, so ids may be null or repeated. The
    digests of texts to be dropped are written as a table, whose size lets
    Spark choose between a broadcast and a shuffle.
    """
    found = _found(docs, benchmark, F.lit(None), text, item_id, item_text, q, edit_share, window)
    bad = durable.rewritten(found.select(F.col("digest").alias("_bad_digest")).distinct(), "bad")
    return docs.join(bad, F.unhex(F.md5(F.col(text).cast("binary"))) == bad["_bad_digest"], "left_anti")
