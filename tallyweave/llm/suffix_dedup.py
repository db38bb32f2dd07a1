"""Removal of repeated byte strings by suffix arrays over shards.

Only text that shares an anchor (the least hash among the k-grams of a string
of the given length) with another place can repeat, so each shard sorts the
suffixes of just that text: prefix doubling in the manner of Larsson and
Sadakane, then common prefixes in text order as Kasai et al. do. That settles
repeats inside a shard. Across shards, each shard sends the stretches of
strings that are new to it, with their bytes, in suffix order. Stretches of one
anchor meet in one place: equal ones are settled whole. The strings of those
that differ are compared as they are, by a plain stable sort: within a stretch
they stand by place and not by suffix, so this step is no merging of sorted
runs. Anchors of very many stretches would fill one place, so their strings
travel one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm import shards, textops

RESULT = "doc_id long, n_bytes long, n_removed long, kept binary, removed array<struct<start:int,end:int>>"

#: Stretches of one anchor beyond which its strings travel one by one, as 128-bit digests.
HOT = 16_384

#: What shards send; equal things meet by anchor. Kind 0: a stretch (anchor, body, document, first string). 1: a string of a
#: hot anchor (body is its digest, anchor half of that). 2: strings [start, end) that repeat in the shard.
SENT = "kind int, anchor long, body binary, doc_id long, shard int, start int, end int"
_SENT = pa.schema([("kind", pa.int32()), ("anchor", pa.int64()), ("body", pa.binary()), ("doc_id", pa.int64()), ("shard", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

#: A byte that no UTF-8 text holds; it parts the stretches whose suffixes are sorted.
_PART = 0xFF

#: The powers of 256 below 2**64.
_BELOW = np.array([1 << (8 * k) for k in range(8)], np.uint64)


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the packed eight bytes at each place."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    packed = np.zeros(n, np.uint64)
    for k in range(8):
        packed = (packed << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(packed, kind="stable")
    rank = np.zeros(n + 1, np.int64)  # a group's rank is the place of its first suffix, from 1; 0 beyond the end
    new = np.ones(n, bool)
    new[1:] = packed[order[1:]] != packed[order[:-1]]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = head + 1
    h = 8
    while True:
        single = new & np.append(new[1:], True)
        at = np.flatnonzero(~single)  # only groups that are not yet sorted
        if not len(at):
            break
        suffix = order[at]
        group, nxt = rank[suffix], rank[np.minimum(suffix + h, n)]
        again = np.lexsort((nxt, group))
        suffix, group, nxt = suffix[again], group[again], nxt[again]
        order[at] = suffix
        split = np.ones(len(at), bool)
        split[1:] = (group[1:] != group[:-1]) | (nxt[1:] != nxt[:-1])
        new[at] = split
        head = np.maximum.accumulate(np.where(split, at, 0))
        rank[suffix] = head + 1
        h *= 2
    return order, packed


def common_prefixes(order: np.ndarray, packed: np.ndarray, cap: int, lanes: int = 4096) -> np.ndarray:
    """For each suffix in order, the bytes it shares with the one before it, up to cap.

    The text is cut into lanes that advance together; in each, the prefix of
    one place is at least that of the place before less one.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    step = max(1, -(-n // lanes))
    start = np.arange(0, n, step)
    have = np.zeros(len(start), np.int64)
    for k in range(step):
        at = start + k
        live = np.flatnonzero(at < n)
        at = at[live]
        other = before[at]
        got = np.maximum(have[live] - 1, 0)
        got[other < 0] = 0
        go = np.flatnonzero((other >= 0) & (got < cap))
        while len(go):
            i, j = at[go] + got[go], other[go] + got[go]
            go = go[(i < n) & (j < n)]
            i, j = at[go] + got[go], other[go] + got[go]
            x = packed[i] ^ packed[j]
            same = (x[:, None] < _BELOW).sum(1)  # equal bytes from the left
            same = np.minimum(same, n - np.maximum(i, j))  # the padding is no text
            got[go] += same
            go = go[(same == 8) & (got[go] < cap)]
        have[live] = got
        shared[at] = got
    return np.minimum(shared[order], cap)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each width consecutive values."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    full = np.concatenate([x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, 1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Shard:
    """The bytes of a shard's documents, in stretches of strings that have one anchor."""

    def __init__(self, table: pa.Table, length: int, gram: int):
        self.table, self.length = table, length
        self.buf, self.offs = textops.batch(table["text"])
        self.sums = textops.byte_sums(self.buf)
        n = len(self.buf)
        self.doc = np.repeat(np.arange(len(self.offs) - 1, dtype=np.int32), np.diff(self.offs))
        self.start = self.end = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        if n < length:
            return
        i = np.arange(n - gram + 1)
        grams = self.sums.hash(i, i + gram)
        # ties go to the first place, so equal strings have their anchors at equal places
        low = np.uint64(0xFFFFFFFF)
        least = sliding_least((grams & ~low) | i.astype(np.uint64), length - gram + 1) & low
        w = n - length + 1
        inside = self.doc[:w] == self.doc[length - 1 :]
        new = np.ones(w, bool)
        new[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
        self.start = np.flatnonzero(new & inside)
        stops = np.append(np.flatnonzero(new | ~inside), w)
        self.end = stops[np.searchsorted(stops, self.start, side="right")]
        self.anchor = grams[least[self.start].astype(np.int64)]

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Stretches whose anchor occurs elsewhere too."""
        distinct, which, n = np.unique(self.anchor, return_inverse=True, return_counts=True)
        return np.flatnonzero(((n > 1) | np.isin(distinct, shared, kind="sort"))[which]) if len(which) else np.zeros(0, np.int64)

    def bodies(self, chosen: np.ndarray) -> pa.Array:
        """The bytes of all strings of each stretch."""
        size = self.end[chosen] - self.start[chosen] + self.length - 1
        total = np.concatenate(([0], np.cumsum(size)))
        return textops.strings(self.buf[np.repeat(self.start[chosen] - total[:-1], size) + np.arange(total[-1])], size, False)

    def local_repeats(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place, whether the string there starts earlier in this shard, and its rank in suffix order."""
        again, rank = np.zeros(len(self.buf), bool), np.zeros(len(self.buf), np.int32)
        if not len(chosen):
            return again, rank
        windows = textops.covered(self.start[chosen], self.end[chosen], len(self.buf))
        s, e = textops.runs(textops.covered(self.start[chosen], self.end[chosen] + self.length - 1, len(self.buf)))
        # stretches of two documents may touch; a string never crosses, so no part sign is needed there
        n = e - s
        to = np.concatenate(([0], np.cumsum(n + 1)))
        text = np.full(to[-1], _PART, np.uint8)
        place = np.repeat(s - to[:-1], n)
        spots = np.repeat(to[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        text[spots] = self.buf[spots + place]
        source = np.full(len(text), -1, np.int64)
        source[spots] = spots + place
        order, packed = suffix_array(text)
        shared = common_prefixes(order, packed, self.length)
        at = source[order]
        ok = (at >= 0) & windows[at]
        group = np.cumsum(shared < self.length)
        at, group = at[ok], group[ok]
        first = np.full(group[-1] + 1 if len(group) else 0, len(self.buf), np.int64)
        np.minimum.at(first, group, at)
        again[at[at != first[group]]] = True
        rank[at] = np.arange(len(at))
        return again, rank


def _ranges(answers: pa.Table, n: int) -> np.ndarray:
    """Which of n places the answers' ranges cover."""
    return textops.covered(*(x.astype(np.int64) for x in shards.numbers(answers, "start", "end")), n)


def remove_repeated_strings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100, gram: int = 40) -> DataFrame:
    """Drop each byte of a string of the given length that also starts earlier in the corpus.

    Texts count as UTF-8 bytes, null as none; strings lie within one document.
    Earlier means a smaller doc_id, or an earlier byte of the same document; a
    null doc_id comes after all others, rows of equal or null doc_id come in an
    order that hashes of their texts give, and of equal rows the second repeats
    the first. An empty table gives an empty result; other columns are ignored.
    A text is read whole by one task, whose arrays take about 60 times its
    bytes. Strings are compared as they are, but for those of anchors with more
    than HOT stretches, which count as equal if their BLAKE2b digests are.
    Returns doc_id, n_bytes, n_removed, kept and the removed byte ranges.
    """
    parts, n = shards.sharded(docs, doc_id, text)
    hot = HOT

    def anchors(table: pa.Table) -> pa.Table:
        keys, count = np.unique(Shard(table, length, gram).anchor, return_counts=True)
        return pa.table({"key": keys.view(np.int64), "shard": shards.me(table, len(keys)), "n": count.astype(np.int32)})

    def sort_suffixes(table: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(table, length, gram)
        keys = answers["key"].to_numpy().view(np.uint64)
        chosen = shard.candidates(keys)
        again, rank = shard.local_repeats(chosen)
        s, e = textops.runs(again)
        out = [{"kind": 2, "anchor": s, "body": pa.nulls(len(s), pa.binary()), "doc_id": pa.nulls(len(s), pa.int64()), "start": s, "end": e}]
        fresh = np.concatenate(([0], np.cumsum(~again)))
        chosen = chosen[fresh[shard.end[chosen]] > fresh[shard.start[chosen]]]  # with a string that is new to this shard
        chosen = chosen[np.isin(shard.anchor[chosen], keys, kind="sort")]  # and that another shard may have
        chosen = chosen[np.argsort(rank[shard.start[chosen]], kind="stable")]
        many = np.isin(shard.anchor[chosen], keys[answers["n"].to_numpy() > hot], kind="sort")
        s = shard.start[chosen[~many]]
        out.append({"kind": 0, "anchor": shard.anchor[chosen[~many]].view(np.int64), "body": shard.bodies(chosen[~many]), "doc_id": shards.ids(shard.doc[s], table), "start": s, "end": shard.end[chosen[~many]]})
        at = np.flatnonzero(textops.covered(shard.start[chosen[many]], shard.end[chosen[many]], len(shard.buf)) & ~again)
        raw = memoryview(shard.buf)
        digests = np.frombuffer(b"".join(hashlib.blake2b(raw[i : i + length], digest_size=16).digest() for i in at.tolist()), np.uint8)
        out.append({"kind": 1, "anchor": digests.view(np.int64)[::2], "body": textops.strings(digests, np.full(len(at), 16), False), "doc_id": shards.ids(shard.doc[at], table), "start": at, "end": at + 1})
        return pa.concat_tables([pa.table({**x, "kind": np.full(len(x["start"]), x["kind"], np.int32), "shard": shards.me(table, len(x["start"]))}).select(_SENT.names).cast(_SENT) for x in out])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # a partition's share, about as much as a shard sends
        if held:
            yield from repeats_across(pa.Table.from_batches(held), length).to_batches()

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        buf, offs = textops.batch(table["text"])
        s, e = (x.astype(np.int64) for x in shards.numbers(answers, "start", "end"))
        at = np.flatnonzero(textops.covered(s, e, len(buf)))
        return _kept(table, buf, offs, textops.covered(at, at + length, len(buf)))

    counted = shards.per_shard(parts, anchors, "key long, shard int, n int").withColumn("shards", F.count("*").over(Window.partitionBy("key"))).withColumn("n", F.sum("n").over(Window.partitionBy("key")))
    sent = shards.resume(parts, counted.where("shards > 1").select("key", "shard", "n"), sort_suffixes, SENT)
    gone = sent.repartition(n, "anchor").mapInArrow(merge, "shard int, start int, end int")
    return shards.resume(parts, gone, cut, RESULT)


def repeats_across(table: pa.Table, length: int) -> pa.Table:
    """Ranges (shard, start, end) of strings that are somewhere earlier, from rows of all kinds that share anchors."""
    kind = table["kind"].to_numpy()
    local = table.filter(pa.array(kind == 2)).select(["shard", "start", "end"])
    single = table.filter(pa.array(kind == 1))
    if len(single):
        digests, _ = textops.batch(single["body"])
        rank = _ranks(single)
        single = single.filter(pa.array(rank != least_owners(digests.view("S16"), rank)))
    stretches = table.filter(pa.array(kind == 0))
    found = [_repeats_in_stretches(stretches, length)] if len(stretches) else []
    return pa.concat_tables([local, single.select(["shard", "start", "end"]), *found])


def _ranks(table: pa.Table) -> np.ndarray:
    """Place of each row in the order of documents: by doc_id, nulls last, then shard and place in the shard."""
    shard, start = shards.numbers(table, "shard", "start")
    doc = table["doc_id"].combine_chunks()
    null = doc.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((start, shard, doc.fill_null(0).to_numpy(zero_copy_only=False), null))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def _repeats_in_stretches(table: pa.Table, length: int) -> pa.Table:
    """Ranges of strings that another of the stretches has from an earlier place."""
    anchor, shard, start = shards.numbers(table, "anchor", "shard", "start")
    rank = _ranks(table)
    body = table["body"].combine_chunks().dictionary_encode().indices.to_numpy()
    first = np.full(int(body.max()) + 1, len(rank))
    np.minimum.at(first, body, rank)
    buf, offs = textops.batch(table["body"])
    end = start + np.diff(offs) - length + 1
    own = rank == first[body]
    whole = np.flatnonzero(~own)
    # of different stretches of one anchor in several shards, the strings are compared
    kept = np.flatnonzero(own)
    kept = kept[np.lexsort((shard[kept], anchor[kept]))]
    head = np.flatnonzero(np.concatenate(([True], anchor[kept][1:] != anchor[kept][:-1])))
    several = shard[kept][head] != shard[kept][np.append(head[1:], len(kept)) - 1]
    open_ = kept[np.repeat(several, np.diff(np.append(head, len(kept))))]
    open_ = np.sort(open_)  # back to the order of arrival
    n = end[open_] - start[open_]
    total = np.concatenate(([0], np.cumsum(n)))
    which = np.repeat(np.arange(len(open_)), n)
    at = np.arange(total[-1]) - total[which]
    out = [shard[whole], start[whole], end[whole]]
    if len(which):
        strings = np.lib.stride_tricks.sliding_window_view(buf, length)[offs[open_][which] + at]
        order = rank[open_][which] * (int(n.max()) + 1) + at
        gone = np.zeros(len(which) + len(open_), bool)  # one false between two stretches
        gone[np.arange(len(which)) + which] = order != least_owners(strings.view(f"S{length}").ravel(), order)
        s, e = textops.runs(gone)
        row = np.searchsorted(total + np.arange(len(total)), s, side="right") - 1
        base = start[open_][row] - total[row] - row
        out = [np.concatenate(x) for x in zip(out, (shard[open_][row], base + s, base + e), strict=True)]
    return pa.table([x.astype(np.int32) for x in out], names=["shard", "start", "end"])


def least_owners(keys: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each key, bytes of one width, the least rank among equal keys."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
    least = np.empty_like(rank)
    least[order] = np.repeat(np.minimum.reduceat(rank[order], first), np.diff(np.append(first, len(keys))))
    return least


def _kept(table: pa.Table, buf: np.ndarray, offs: np.ndarray, gone: np.ndarray) -> pa.Table:
    ends = np.concatenate(([0], np.cumsum(~gone)))
    s, e = textops.runs(gone)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    spans = [[] for _ in range(len(offs) - 1)]
    for i, j in zip(s.tolist(), e.tolist(), strict=True):
        while i < j:  # a run may go on into the next document
            d = int(doc[i])
            stop = min(j, int(offs[d + 1]))
            spans[d].append({"start": i - int(offs[d]), "end": stop - int(offs[d])})
            i = stop
    size = np.diff(offs)
    kept = np.diff(ends[offs])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table({"doc_id": table["doc_id"], "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(size - kept, pa.int64()), "kept": textops.strings(buf[~gone], kept, False), "removed": pa.array(spans, kind)})
