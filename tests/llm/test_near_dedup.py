import random

import numpy as np
import pytest

from tallyweave.llm import components, near_dedup
from tests.llm.cases import corpus, documents, groups, prose


@pytest.mark.parametrize(("words", "seed"), [(2, 11), (5, 12)])
def test_groups_equal_brute_force(spark, words, seed):
    texts = corpus(seed)
    got = near_dedup.near_duplicates(documents(spark, texts), words=words).orderBy("doc_id").collect()
    want = groups(list(range(len(texts))), texts, words, 80)
    assert [(r.n_shingles, r.component_id) for r in got] == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_chain_of_drifting_copies_is_one_group(spark):
    """Neighbours are similar, ends are not; the first member alone would miss most links."""
    r = random.Random(8)
    text = prose(r, 120).split()
    texts = []
    for _ in range(40):
        texts.append(" ".join(text))
        for _ in range(3):
            text[r.randrange(len(text))] = prose(r, 1) + "q"
    r.shuffle(texts)
    got = near_dedup.near_duplicates(documents(spark, texts), words=2).orderBy("doc_id").collect()
    assert [(x.n_shingles, x.component_id) for x in got] == groups(list(range(40)), texts, 2, 80)


@pytest.mark.parametrize(("block", "codes"), [(3, 1 << 20), (1000, 300)])
def test_large_buckets_are_compared_in_blocks(spark, monkeypatch, block, codes):
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_CODES", codes)
    test_a_chain_of_drifting_copies_is_one_group(spark)


def test_links_whose_sketches_err_are_kept(spark):
    """Pairs at exactly 0.8 that meet in a band, with estimates of 0.61 and 0.63."""
    texts = []
    for shared, one, other in [
        ("w843467 w391238 w549408 w896275 w529056 w533641 w406533 w265349", "w688588", "w753827"),
        ("w491838 w223253 w565500 w947218 w147069 w589511 w868728 w273360", "w663104", "w531383"),
    ]:
        texts += [f"{shared} {one}", f"{shared} {other}"]
    got = near_dedup.near_duplicates(documents(spark, texts), words=1).orderBy("doc_id").collect()
    assert [r.component_id for r in got] == [0, 0, 2, 2]


def test_intersections_equal_set_arithmetic(monkeypatch):
    monkeypatch.setattr(near_dedup, "CODES", 50)
    monkeypatch.setattr(near_dedup, "COLUMNS", 7)
    r = random.Random(4)
    pool = [r.getrandbits(64) for _ in range(60)]
    sets = [set(r.sample(pool, r.randrange(1, 40))) for _ in range(12)]
    got = near_dedup._intersections([np.array(sorted(s), np.uint64) for s in sets], np.array([3, 7]))
    assert got.tolist() == [[len(sets[i] & s) for s in sets] for i in (3, 7)]


def test_null_and_repeated_ids_and_empty_table(spark):
    ids, texts = [None, 4, 4, 2, 9], ["a b c", "a b c", "x y z", "a b c", None]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dedup.near_duplicates(documents(spark, texts, ids), words=2).collect())
    assert got == [("2", 2, "2", True), ("4", 2, "2", False), ("4", 2, "4", True), ("9", 0, "9", True), ("None", 2, "None", True)]
    assert near_dedup.near_duplicates(documents(spark, ["x"]).where("false")).count() == 0


@pytest.mark.parametrize("swap", [False, True])
def test_equal_ids_keep_the_links_of_each_text(spark, swap):
    """Rows (1, A), (1, B), (2, B and a word more): the second and third are linked in either order."""
    r = random.Random(17)
    a, b = prose(r, 60), prose(r, 60)
    rows = [(1, a), (1, b), (2, b + " extra")]
    ids, texts = zip(*(rows[::-1] if swap else rows), strict=True)
    got = near_dedup.near_duplicates(documents(spark, texts, ids), words=2).collect()
    assert sorted((x.doc_id, x.component_id, x.kept) for x in got) == [(1, 1, True), (1, 1, True), (2, 1, False)]


def test_one_of_each_with_null_and_repeated_ids(spark):
    r = random.Random(18)
    a, b, c = (prose(r, 60) for _ in range(3))
    ids = [None, None, 3, 3, 3, 5, 5, 8, 9, None, None]
    texts = [a, a, b, b, c, b, c + " more", None, "", b + " end", None]
    docs = documents(spark, texts, ids)
    got = near_dedup.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((str(x.doc_id), str(x.text)) for x in got.collect()) == sorted([("None", a), ("3", b), ("3", c), ("8", "None"), ("9", ""), ("None", "None")])
    assert near_dedup.one_of_each(docs.where("false")).count() == 0


def test_leads_of_many_members_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PART", 3)
    r = random.Random(19)
    text = prose(r, 80)
    texts = [f"{text} {prose(r, 1)}q{i}" for i in range(40)] + [prose(r, 80) for _ in range(10)]
    got = near_dedup.near_duplicates(documents(spark, texts)).orderBy("doc_id").collect()
    assert [x.component_id for x in got] == [0] * 40 + list(range(40, 50))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 400), (400, 450)], "a long, b long")
    got = {r.node: r.label for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(range(101), 0), 400: 400, 450: 400, 500: 400}


def shuffled_bytes(spark):
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_texts_that_meet_nothing_are_not_shuffled(spark):
    """Long texts that share no shingle, and three copies of short ones; joins aren't broadcast for their size."""
    r = random.Random(23)
    texts = [" ".join(f"{r.getrandbits(64):x}" for _ in range(1500)) for _ in range(150)] + [prose(r, 60) for _ in range(3)] * 2
    docs = documents(spark, texts).localCheckpoint()
    before, threshold = shuffled_bytes(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(x.doc_id for x in near_dedup.one_of_each(docs).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == list(range(153))
    assert shuffled_bytes(spark) - before < sum(map(len, texts)) / 4


@pytest.mark.parametrize("bits", [1 << 15, 1 << 26])
def test_a_sieve_loses_no_key_and_no_row(spark, monkeypatch, bits):
    monkeypatch.setattr(near_dedup, "SIEVE_BITS", bits)
    rows = spark.range(60_000).selectExpr("id", "unhex(md5(cast(id as string))) key", "'x' _chunk0", "'y' _bitmap0")
    among, others = near_dedup._sieved(rows, "key", rows.where("id % 3 = 0").select("key"))
    assert among.columns == others.columns == rows.columns
    found = {x.id for x in among.select("id").collect()}
    assert found >= set(range(0, 60_000, 3))
    assert found.isdisjoint(left := {x.id for x in others.select("id").collect()}) and len(found) + len(left) == 60_000
    assert len(left) > (36_000 if bits > 1 << 15 else 15_000)
    assert near_dedup._sieved(rows, "key", rows.where("false").select("key"))[1].count() == 60_000


def completed_tasks(spark):
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).numCompleteTasks() for i in range(stages.size()))


def test_few_links_in_many_partitions_take_few_tasks(spark):
    """In partitions that Spark doesn't coalesce; it took 2,935 tasks while each round read its tables by all of them."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    plain = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        before = completed_tasks(spark)
        test_components_of_a_long_chain(spark)
        assert completed_tasks(spark) - before < 2_000
    finally:
        for k, v in plain.items():
            spark.conf.set(k, v)
