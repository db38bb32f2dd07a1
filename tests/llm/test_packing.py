import os
import random
import zlib

import numpy as np
import pytest

from tallyweave.llm import packing, queries
from tests.llm.cases import corpus, documents

pytest.importorskip("public_tokenizers")

ODD = ["a <|endoftext|> b<|endoftext|>c", "İstanbul ſK x y\u0085z\x1cq 's it's I'VE  5678 é ́x", "日本語 ΣΑΣ", "it's'll''s 'scum !'s 'rent x'dd 12a³²¼ñ_'t z'l'r 've", "'", "x'", " don’t É'S"]


def ids_of(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return [np.array([*e.ids, 0], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_pieces_and_sequences(spark):
    texts = corpus() + ODD
    got = packing.pack_documents(documents(spark, texts), queries.tokenizer_path(), size=256).orderBy("doc_id", "piece").collect()
    want = [(d, p, s, len(x[s : s + 256]), zlib.crc32(x[s : s + 256].tobytes())) for d, x in enumerate(ids_of(texts)) for p, s in enumerate(range(0, len(x), 256))]
    assert [tuple(r)[:5] for r in got] == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in got)
    assert len(places) <= 1.05 * total / 256 + 1


def test_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the third closes sequence 1, the fullest
    assert bins.place(4) == (0, 6) and bins.place(2) == (2, 8) and bins.place(3) == (3, 0)


def best_fit(lengths, size, most, ahead):
    """(sequence, offset) of each piece by plain lists, and how many sequences closed with room left."""
    out, open_, made, closed = [None] * len(lengths), [], 0, 0
    for s in range(0, len(lengths), ahead):
        for i in sorted(range(s, min(s + ahead, len(lengths))), key=lambda i: -lengths[i]):
            fits = [b for b in open_ if b[0] >= lengths[i]]
            if fits:
                best = min(b[0] for b in fits)
                b = [b for b in fits if b[0] == best][-1]  # the one that came to this room last
                open_.remove(b)
            else:
                if len(open_) >= most:
                    least = min(b[0] for b in open_)
                    open_.remove([b for b in open_ if b[0] == least][-1])
                    closed += 1
                b = [size, made]
                made += 1
            out[i] = (b[1], size - b[0])
            b[0] -= lengths[i]
            if b[0]:
                open_.append(b)
    return out, closed


def test_placement_equals_plain_lists():
    r = random.Random(0)
    for most, ahead in ((3, 1), (8, 5), (20, 64)):
        lengths = [r.randrange(1, 101) for _ in range(400)]
        want, closed = best_fit(lengths, 100, most, ahead)
        assert [tuple(x) for x in packing.place_all(lengths, 100, most, ahead).tolist()] == want and closed > 20


def test_sequences_close_early_and_little_is_lost(spark):
    """The query's own bound: arrival in order, many more pieces than open sequences."""
    r = random.Random(1)
    lengths = [r.choice([2048, r.randrange(1, 2049), r.randrange(900, 1300)]) for _ in range(6000)]
    assert best_fit(lengths, 2048, packing.OPEN_BINS, packing.LOOK_AHEAD)[1] > 100
    pieces = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], packing.PIECES)
    got = packing.pack(pieces).collect()
    assert sorted((x.doc_id, x.length) for x in got) == list(enumerate(lengths))
    places = {}
    for x in got:
        places.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in places.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]
    assert max(sum(n for _, n in p) for p in places.values()) <= 2048


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_the_query_is_within_one_percent_of_the_bound(spark):
    got = queries.op9_best_fit_packing(spark, "/root/testdata/sf0.01").agg({"length": "sum", "sequence_id": "count"}).first()
    n = queries.op9_best_fit_packing(spark, "/root/testdata/sf0.01").select("sequence_id").distinct().count()
    assert n <= 1.01 * got["sum(length)"] / 2048 + 1


def test_null_and_repeated_rows(spark):
    docs = documents(spark, ["one two", "one two", None, "", "one two"], [None, None, 3, 3, 3])
    got = packing.pack_documents(docs, queries.tokenizer_path(), size=4).collect()
    assert sorted((str(r.doc_id), r.length) for r in got) == [("3", 1), ("3", 1), ("3", 3), ("None", 3), ("None", 3)]
    assert len({(r.sequence_id, r.offset) for r in got}) == 5


def test_ids_are_kept_on_request_and_empty_table(spark):
    docs = documents(spark, ["one two", None])
    got = packing.token_pieces(docs, queries.tokenizer_path(), keep_ids=True).orderBy("doc_id").collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [x.tolist() for x in ids_of(["one two", None])]
    assert packing.pack_documents(docs.where("false"), queries.tokenizer_path()).count() == 0
