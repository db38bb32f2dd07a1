"""Near duplicates by MinHash bands, odd sketches and full shingle sets.

Documents with equal shingle sets are one from the start. Bands of MinHash
values name the buckets in which similar documents meet. Each bucket links its
members with its first one only; a candidate pair is dropped where its odd
sketches (parity bitmaps of the MinHash samples, of which the set bits of the
exclusive or tell the similarity) are clearly apart, and else compared on the
full sets. Where a bucket then still holds several components, its members of
different components are compared too, so that no link between components is
lost to the choice of the first member.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import durable, textops
from tallyweave.llm.components import TASK_ROWS, components

#: Bands and MinHash values in each: a pair of similarity 0.8 meets in none of them once in 1.4e9.
BANDS, ROWS = 40, 4

#: Bits of a sketch, and how far below the threshold an estimate may fall: at 0.8 it falls further once in 4.5e9.
SKETCH_BITS, MARGIN = 1_024, 0.24

#: In a bucket of at most SMALL members of several components, pairs are joined; larger ones are compared in blocks of
#: BLOCK by products of their sets' incidence, of which COLUMNS are held at a time, from about CODES shingles at a time.
#: A block ends at BLOCK_CODES shingles too.
SMALL, BLOCK, BLOCK_CODES, COLUMNS, CODES = 16, 1_024, 1 << 20, 4_096, 1 << 21

#: Members that are compared with one lead side by side; more make more parts, each with the lead's set once.
PART = 256

#: Nodes that one task reads, if there are as many, each with its bands and sketch; of ids alone it reads TASK_ROWS.
TASK_NODES = 4_096

#: Bits of a sieve for each key in it, and at most (8 MB); with more keys than it can tell apart it lets more rows pass, and the result stays.
#: It is broadcast in chunks, of as many bits as a bitmap of Spark's has.
KEY_BITS, SIEVE_BITS, CHUNK_BITS = 16, 1 << 26, 1 << 15

SIGNATURE = "doc_id long, row_key binary, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"

_K = BANDS * ROWS
_FACTORS = textops.mix(np.arange(1, _K + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text its different shingles' codes, ascending, one text after another; and where each text's begin."""
    buf, offs = textops.batch(texts)
    buf = textops.lower_ascii(buf)
    start, end, first = textops.words(buf, offs)
    n = np.diff(first)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(n) + 1, np.int64)
    sums = textops.Sums(textops.word_codes(buf, start, end))
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(start))
    room = first[doc + 1] - at
    whole = (n[doc] < words) & (at == first[doc])  # fewer words than a shingle: the sequence is one
    chosen = np.flatnonzero((room >= words) | whole)
    codes = sums.hash(chosen, chosen + np.minimum(words, room[chosen]))
    doc = doc[chosen]
    order = np.lexsort((codes, doc))
    codes, doc = codes[order], doc[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (doc[1:] != doc[:-1])
    return codes[new], np.searchsorted(doc[new], np.arange(len(n) + 1))


def sign(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketches of non-empty sets."""
    m = len(first) - 1
    least = np.empty((_K, m), np.uint64)
    for i in range(_K):
        least[i] = np.minimum.reduceat(codes * _FACTORS[i], first[:-1])
    bands = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], m, 1)  # so that keys of two bands differ
    for r in range(ROWS):
        bands = textops.mix(bands ^ least[r::ROWS])
    place = textops.mix(least ^ _FACTORS[:, None]) % np.uint64(SKETCH_BITS)
    flips = np.zeros((m, SKETCH_BITS), np.uint8)
    np.bitwise_xor.at(flips, (np.tile(np.arange(m), _K), place.ravel().astype(np.int64)), 1)
    return bands.T, np.packbits(flips, axis=1, bitorder="little").view("<u8")


def signatures(rows: DataFrame, words: int) -> DataFrame:
    """Of (doc_id, text, row_key): set size, a 128-bit name of the set, band keys and sketch; the last two null for an empty set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in textops.slices(batch):
                codes, first = shingle_sets(b.column(1), words)
                n = np.diff(first)
                full = np.flatnonzero(n)
                name = np.zeros((2, len(n)), np.uint64)
                bands, sketch = [None] * len(n), [None] * len(n)
                if len(full):
                    own = first[np.append(full, len(n))]
                    name[0, full] = np.add.reduceat(textops.mix(codes), own[:-1])
                    name[1, full] = np.add.reduceat(textops.mix(codes ^ np.uint64(0x5851F42D4C957F2D)), own[:-1])
                    keys, bits = sign(codes, own)
                    for i, k, s in zip(full.tolist(), keys.view(np.int64), bits.view(np.int64), strict=True):
                        bands[i], sketch[i] = k, s
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(name[0].view(np.int64)), pa.array(name[1].view(np.int64)), pa.array(bands, longs), pa.array(sketch, longs)], names=["doc_id", "row_key", "n_shingles", "set_a", "set_b", "bands", "sketch"])

    return rows.mapInArrow(textops.light(work), SIGNATURE)


def _similarity(x: Column, y: Column) -> Column:
    """Estimated from two sketches."""
    apart = F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b)).cast("long")), F.lit(0).cast("long"), lambda s, n: s + n)
    share = F.least(apart.cast("double") * 2 / SKETCH_BITS, F.lit(0.999999))
    return 1 + F.log(1 - share) * (SKETCH_BITS / 2) / (2 * _K)


def _similar(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    apart = np.bitwise_count(x ^ y).sum(-1)
    return 1 + np.log1p(-np.minimum(apart * 2 / SKETCH_BITS, 0.999999)) * (SKETCH_BITS / 2) / (2 * _K)


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose full shingle sets have intersection * 100 >= percent * union.

    A lead and PART of its members stand side by side, so its text is sent once
    for so many, and a lead of very many members is dealt out.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    members = pairs.join(counts, "a").select("a", part.alias("part"), F.col("b").alias("node"), F.lit(1).alias("role"))
    leads = counts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("node"), F.lit(0).alias("role"))
    rows = members.unionByName(leads).join(texts, "node").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = np.zeros(0, np.uint64)
        for batch in batches:
            for b in textops.slices(batch):
                codes, first = shingle_sets(b.column("text"), words)
                role, a, node = (b.column(c).to_numpy() for c in ("role", "a", "node"))
                good = np.zeros(b.num_rows, bool)
                for i in range(b.num_rows):
                    own = codes[first[i] : first[i + 1]]
                    if not role[i]:
                        lead = own
                        continue
                    both = int((lead[np.minimum(np.searchsorted(lead, own), len(lead) - 1)] == own).sum())
                    good[i] = 100 * both >= percent * (len(lead) + len(own) - both)
                yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(node[good])], names=["a", "b"])

    return rows.select("a", "part", "role", "node", "text").mapInArrow(textops.light(check), "a long, b long").distinct()


def _across_small(members: DataFrame, least: float) -> DataFrame:
    """Pairs of different components in one small bucket whose sketches are near enough."""
    x, y = (members.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "label", "sketch"))) for s in "xy")
    pairs = x.join(y, "key").where("label_x < label_y").where(_similarity(F.col("sketch_x"), F.col("sketch_y")) >= least)
    return pairs.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def _open_pairs(table: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """node, label, and which pairs of a cell are of different components and blocks and near enough by their sketches."""
    node, label, mine = (table[c].to_numpy() for c in ("node", "label", "mine"))
    sketch = table["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
    open_pair = label[:, None] != label[None, :]
    if table["i"][0].as_py() != table["j"][0].as_py():
        open_pair &= mine[:, None] != mine[None, :]
    for x in np.flatnonzero(open_pair.any(1)).tolist():
        at = np.flatnonzero(open_pair[x])
        open_pair[x, at] = _similar(sketch[x], sketch[at]) >= least
    return node, label, open_pair


def _links_in_large(members: DataFrame, texts: DataFrame, least: float, words: int, percent: int) -> DataFrame:
    """Links between components in large buckets, as forests.

    Every open link has an end outside of a bucket's largest component. So the
    rest is cut into blocks, the largest component too, and each block of the
    rest meets every other block in a cell. Cells are pruned by sketches alone;
    for what stays, full sets are compared by products of their incidence, and
    of the links found only a spanning forest leaves, so a cell of many similar
    documents gives fewer rows than members.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in textops.slices(batch):
                codes, first = shingle_sets(b.column(1), words)
                yield pa.RecordBatch.from_arrays([b.column(0), textops.strings(codes.view(np.uint8), 8 * np.diff(first), False)], names=["node", "codes"])

    each = members.groupBy("key", "label").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("s"))
    blocks = lambda c, s: F.greatest(F.ceil(c / BLOCK), F.ceil(s / BLOCK_CODES)).cast("int")
    top = F.max(F.struct("c", "label", "s"))
    split = each.groupBy("key").agg(top.alias("top"), F.sum("c").alias("c"), F.sum("s").alias("s"))
    split = split.select("key", F.col("top.label").alias("top"), blocks(F.col("c") - F.col("top.c"), F.col("s") - F.col("top.s")).alias("rest"), blocks(F.col("top.c"), F.col("top.s")).alias("core"))
    largest = F.col("label") == F.col("top")
    mine = F.when(largest, F.col("rest") + F.pmod(F.xxhash64("node"), F.col("core"))).otherwise(F.pmod(F.xxhash64("node"), F.col("rest"))).cast("int")
    others = F.sequence(F.lit(0), F.when(largest, F.col("rest")).otherwise(F.col("rest") + F.col("core")) - 1)
    cell = F.explode(F.transform(others, lambda o: F.struct(F.least(F.col("mine"), o).alias("i"), F.greatest(F.col("mine"), o).alias("j"))))
    dealt = members.join(split, "key").withColumn("mine", mine).withColumn("cell", cell).select("key", "cell.i", "cell.j", "mine", "node", "label", "sketch")

    def near(table: pa.Table) -> pa.Table:
        open_pair = _open_pairs(table, least)[2]
        return table.filter(pa.array(open_pair.any(1)))

    kinds = "key long, i int, j int, mine int, node long, label long, sketch array<long>"
    stay = durable.checkpoint(dealt.groupBy("key", "i", "j").applyInArrow(near, kinds))
    whole = texts.join(stay.select("node").distinct(), "node", "left_semi").select("node", "text").mapInArrow(textops.light(sets), "node long, codes binary")

    def compare(table: pa.Table) -> pa.Table:
        node, label, open_pair = _open_pairs(table := table.sort_by("node"), least)
        _, which, count = np.unique(label, return_inverse=True, return_counts=True)
        out = np.flatnonzero(which != count.argmax())  # an open pair has an end outside of the largest component
        codes = [np.frombuffer(c, np.uint64) for c in table["codes"].to_pylist()]
        size = np.array([len(c) for c in codes])
        links = np.zeros((len(node), len(node)), bool)
        both = _intersections(codes, out)
        links[out] = (100 * both >= percent * (size[out, None] + size[None, :] - both)) & open_pair[out]
        links |= links.T
        a, b = _forest(links)
        return pa.table({"a": pa.array(node[a], pa.int64()), "b": pa.array(node[b], pa.int64())})

    return stay.join(whole, "node").groupBy("key", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _intersections(codes: list[np.ndarray], out: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the chosen sets with all sets; each set's codes ascend."""
    both = np.zeros((len(out), len(codes)))
    parts = 1 + sum(map(len, codes)) // CODES
    edges = np.array([i * (1 << 64) // parts for i in range(1, parts)], np.uint64)
    cuts = [np.concatenate(([0], np.searchsorted(c, edges), [len(c)])) for c in codes]
    for i in range(parts):
        pieces = [c[at[i] : at[i + 1]] for c, at in zip(codes, cuts, strict=True)]
        _, which, count = np.unique(np.concatenate(pieces), return_inverse=True, return_counts=True)
        shared = count > 1  # a shingle of one set is in no intersection
        owner = np.repeat(np.arange(len(codes)), [len(c) for c in pieces])[shared[which]]
        column = (np.cumsum(shared) - 1)[which][shared[which]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for at in range(0, int(shared.sum()), COLUMNS):
            lo, hi = np.searchsorted(column, (at, at + COLUMNS))
            part = np.zeros((len(codes), COLUMNS), np.float32)
            part[owner[lo:hi], column[lo:hi] - at] = 1
            both += part[out] @ part.T  # whole numbers up to 4,096: exact
    return both


def _forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a symmetric relation: each reached place and the one it was reached from."""
    left, a, b = np.ones(len(links), bool), [], []
    for root in range(len(links)):
        todo = [root] if left[root] else []
        left[root] = False
        while todo:
            x = todo.pop()
            new = np.flatnonzero(links[x] & left)
            left[new] = False
            a += [x] * len(new)
            b += new.tolist()
            todo += new.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _row_key(doc_id: Column, text: Column) -> Column:
    """A digest that tells rows of different id or text apart; rows alike in both share it."""
    return F.unhex(F.md5(F.concat_ws("\x00", doc_id.cast("string"), text)))


def _groups(rows: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows' signatures; and for each shingle set its node and the label of the component that it is in.

    A node is one distinct set, so rows of equal doc_id are told apart by their
    texts. Each node's row of the smallest (doc_id, digest) stands for it.
    """
    least = percent / 100 - MARGIN
    signed = durable.checkpoint(signatures(rows, words))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    sets = signed.where("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min(order).alias("of"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    nodes = durable.checkpoint(sets.withColumn("node", F.monotonically_increasing_id()).select("node", "set_a", "set_b", "of.doc_id", "of.row_key", "n_shingles", "bands", "sketch"), TASK_NODES)
    sketches = nodes.select("node", "n_shingles", "sketch")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    buckets = durable.checkpoint(keyed.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1"), TASK_ROWS)
    met = durable.checkpoint(keyed.join(buckets, "key").select("key", "node", "lead", "n"), TASK_ROWS)
    stars = met.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    x, y = (sketches.select(F.col("node").alias(c), F.col("sketch").alias(f"sketch_{c}")) for c in "ab")
    near = durable.checkpoint(stars.join(x, "a").join(y, "b").where(_similarity(F.col("sketch_a"), F.col("sketch_b")) >= least).select("a", "b"), TASK_ROWS)
    texts = _texts(rows, nodes, met.select("node").distinct())
    links = durable.checkpoint(_confirm(near, texts, words, percent), TASK_ROWS)
    labels = components(links)

    labelled = met.join(labels, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label"))
    torn = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    members = durable.checkpoint(labelled.join(torn, "key").join(sketches, "node"), TASK_NODES)
    small, large = members.where(f"n <= {SMALL}"), members.where(f"n > {SMALL}")
    more = durable.checkpoint(_across_small(small, least).join(near, ["a", "b"], "left_anti"), TASK_ROWS)
    late = [_confirm(more, texts, words, percent)] if not more.isEmpty() else []
    if not large.isEmpty():
        late.append(_links_in_large(large, texts, least, words, percent))
    if late:
        late = durable.checkpoint(reduce(DataFrame.unionByName, late), TASK_ROWS)
        if not late.isEmpty():
            labels = components(links.unionByName(late))
    return signed, nodes.join(labels, "node", "left").select("node", "set_a", "set_b", "doc_id", "row_key", F.coalesce("label", "node").alias("label"))


def _unused(taken: list[str], *names: str) -> list[str]:
    """The names, each with a number that makes it one that no column has."""
    return [next(n for n in (f"{name}{i}" for i in range(len(taken) + 1)) if n not in taken) for name in names]


def _sieved(rows: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be among the wanted ones (a single column), and those whose key surely isn't.

    A broadcast bitmap of the keys' hashes tells them apart where they are read,
    so that only the first need be shuffled, with their texts, for an exact join.
    """
    bits = min(SIEVE_BITS, max(CHUNK_BITS, 1 << (KEY_BITS * wanted.count()).bit_length()))
    chunk, bitmap = _unused(rows.columns, "_chunk", "_bitmap")

    def placed(column: str) -> tuple[Column, Column]:
        at = F.xxhash64(column).bitwiseAND(F.lit(bits - 1))
        return F.floor(at / CHUNK_BITS), at.bitwiseAND(F.lit(CHUNK_BITS - 1))

    its, bit = placed(wanted.columns[0])
    chunks = wanted.select(its.alias(chunk), bit.alias("bit")).repartition(chunk).groupBy(chunk).agg(F.bitmap_construct_agg("bit").alias(bitmap))
    its, bit = placed(key)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    told = rows.join(F.broadcast(chunks), its == F.col(chunk), "left")
    among = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    return told.where(among).select(rows.columns), told.where(~among).select(rows.columns)


def _texts(rows: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and text of the wanted nodes, written once."""
    keys = durable.checkpoint(nodes.join(wanted, "node", "left_semi").select("row_key", "node"), TASK_ROWS)
    among, _ = _sieved(rows.select("row_key", "text"), "row_key", keys.select("row_key"))
    return durable.checkpoint(among.join(keys, "row_key").dropDuplicates(["row_key"]).select("node", "text"))


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    key = _row_key(F.col(doc_id).cast("long"), F.col(text))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), key.alias("row_key"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and kept, one row for each row.

    Two documents are linked if their sets of word shingles have
    100 * intersection >= percent * union. A null, empty or blank text has an
    empty set and no links; a null doc_id has none either, is its own (null)
    component and is kept. Rows of equal doc_id are judged each by its own
    text; equal rows give equal rows. An empty table gives an empty result,
    other columns are ignored, and long texts count whole.

    There are two chances in the result: at 0.8, a pair meets in no band with
    a probability of 7.0e-10, and its sketches are further apart than MARGIN
    allows with one of 2.2e-10; both are less above it.
    """
    rows = _rows(docs, doc_id, text)
    signed, nodes = _groups(rows.where("doc_id is not null"), words, percent)
    low = nodes.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = signed.where("n_shingles > 0").join(nodes.join(low, "label").select("set_a", "set_b", "component_id"), ["set_a", "set_b"])
    empty = signed.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    no_id = signatures(rows.where("doc_id is null"), words).withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")]
    return linked.select(*columns).unionByName(empty.select(*columns)).unionByName(no_id.select(*columns))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows, with all their columns, without near duplicates: of each component the row of the smallest doc_id stays.

    Rows are told apart by id and text, so repeated and null ids do no harm: of
    rows alike in both one stays, a null doc_id comes after all others, and of
    equal ids the smaller digest. Rows without shingles all stay. An empty
    table gives an empty result.
    """
    key, row = _unused(docs.columns, "_row_key", "_row")
    signed, nodes = _groups(_rows(docs, doc_id, text), words, percent)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    first = nodes.groupBy("label").agg(F.min(order).alias("of")).select(F.col("of.row_key").alias(row))
    full = signed.where("n_shingles > 0")
    copies = durable.rewritten(full.select(F.col("row_key").alias(row)).distinct().join(first, row, "left_anti"), "copies")
    twice = durable.rewritten(full.groupBy(F.col("row_key").alias(row)).agg(F.count("*").alias("_n")).where("_n > 1").select(row), "twice")
    keyed = docs.withColumn(key, _row_key(F.col(doc_id).cast("long"), F.col(text)))
    again = F.col(key) == F.col(row)
    among, others = _sieved(keyed, key, copies.unionByName(twice))
    kept = among.join(copies, again, "left_anti")
    if not twice.isEmpty():
        kept = kept.join(twice, again, "left_anti").unionByName(kept.join(twice, again, "left_semi").dropDuplicates([key]))
    return others.unionByName(kept).select(docs.columns)
