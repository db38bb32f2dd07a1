import random

import pytest

from tests.llm.cases import CLASHING, documents, prose
from tests.llm.test_toxicity import BAD

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A corpus in which toxic, near-duplicate and contaminated documents are known."""
    r = random.Random(21)
    d = tmp_path_factory.mktemp("sf")
    bench = [prose(r, 35) for _ in range(4)]
    texts, labels = [], []
    for i in range(200):
        ws = prose(r, 60).split()
        if i % 4 == 0:
            for _ in range(3):
                ws.insert(r.randrange(len(ws)), r.choice(BAD))
        texts.append(" ".join(ws))
        labels.append((i, int(i % 4 == 0)))
    copies = {200 + i: 4 * i + 1 for i in range(10)}
    texts += [texts[j] + " tail" for j in copies.values()]
    texts += [f"{prose(r, 20)} {b} {prose(r, 20)}" for b in bench]
    texts += [f"{prose(r, 20)} 4845168114407329 {prose(r, 20)}", None, ""]
    docs = documents(spark, texts).selectExpr("doc_id", "text", "'en' lang", "'s' source", "cast(length(text) as bigint) n_chars", *(c for c in CLASHING))
    docs.write.parquet(str(d / "documents.parquet"))
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
    return str(d), texts, copies


def test_each_stage_drops_what_it_should(spark, folder):
    d, texts, copies = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        docs.write.parquet(f"{d}/out-{name}")
        docs = spark.read.parquet(f"{d}/out-{name}")
        if name != "pack":
            assert docs.columns == columns
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    everything, toxic = set(range(len(texts))), {i for i in range(200) if i % 4 == 0}
    assert len(seen[0] & toxic) <= 3 and len((everything - toxic) - seen[0]) <= 3
    assert seen[1] == seen[0] - {c for c, o in copies.items() if o in seen[0]}
    assert seen[2] == seen[1] - set(range(210, 214))
    assert seen[3] == seen[2] == seen[4]
    text = spark.read.parquet(f"{d}/out-pii").where("doc_id = 214").first()
    assert "4845168114407329" not in text.text and text.n_chars == len(text.text)


def test_run_gives_the_last_stage(spark, folder):
    d, *_ = folder
    assert corpus_pipeline.run(spark, d).count() == spark.read.parquet(f"{d}/out-pack").count()


def test_null_and_repeated_rows_in_each_stage(spark, folder):
    """Rows are judged by their texts; of rows alike one stays after the second stage, and null texts stay throughout."""
    d, texts, _ = folder
    r = random.Random(22)
    clean, other = prose(r, 60), prose(r, 60)
    toxic = " ".join(f"{BAD[i % len(BAD)]} {prose(r, 8)}" for i in range(6))
    leak = f"{prose(r, 20)} {spark.read.parquet(f'{d}/benchmark.parquet').first().text} {prose(r, 20)}"
    rows = [(None, clean), (None, clean), (1007, other), (1007, other), (1007, clean + " more"), (None, toxic), (1007, toxic), (None, leak), (1008, None), (None, None), (1009, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    base = spark.read.parquet(f"{d}/documents.parquet").select(docs.columns)
    docs, seen = base.unionByName(docs), []
    own = lambda df: df.where("doc_id is null or doc_id >= 1000")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d)
        seen.append(sorted((str(x.doc_id), str(x.text)) for x in own(docs).collect()))
    assert seen[0] == sorted((str(i), str(t)) for i, t in rows if t != toxic)
    assert seen[1] == sorted([("1007", other), ("1007", clean + " more"), ("None", leak), ("1008", "None"), ("None", "None"), ("1009", "")])
    assert seen[2] == seen[3] == sorted(x for x in seen[1] if x[1] != leak)
    assert sum(x.length for x in own(corpus_pipeline.STAGES[-1][1](spark, docs, d)).where("doc_id is null or doc_id > 1007").collect()) == 3


def test_empty_tables_in_each_stage(spark, folder, tmp_path):
    d, *_ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{d}/{name}.parquet").where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in (corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[2]):  # no labels, no benchmark: all stay
        assert stage(spark, docs, str(tmp_path)).count() == docs.count()
