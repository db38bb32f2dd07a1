import pickle
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from tallyweave.sources import frames, readers


def write(path, text, sizes, checksum=False):
    """The text in frames of so many bytes each, which needn't end with lines."""
    made, at = [], 0
    for i, n in enumerate(sizes):
        made.append(zstandard.ZstdCompressor(write_checksum=checksum, write_content_size=bool(i % 2)).compress(text[at : at + n]))
        if i == 1:
            made.append(b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc")  # a frame to skip
        at += n
    path.write_bytes(b"".join(made))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("end", [b"", b"\n"])
def test_many_frames_equal_the_whole(spark, tmp_path, seed, end):
    r = random.Random(seed)
    lines = [("x" * r.choice([0, 1, 5, 60]) + f"\té{i}") for i in range(200)]
    text = "\n".join(lines).encode() + end
    cuts = sorted(r.sample(range(1, len(text)), 25) + [text.index(b"\n", 500) + 1, text.index(b"\n", 700)])
    write(tmp_path / "a.zst", text, [b - a for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)], checksum=seed % 2 == 0)
    write(tmp_path / "b.zst", b"one\ntwo\n", [8])
    df = frames.zstd_lines(spark, str(tmp_path / "*.zst"), part_bytes=1)
    got = sorted((x.line, x.value) for x in df.where(F.col("path").endswith("a.zst")).collect())
    assert got == list(enumerate(lines))
    assert sorted((x.line, x.value) for x in df.where(F.col("path").endswith("b.zst")).collect()) == [(0, "one"), (1, "two")]
    raw = spark.read.format("zstd_lines").option("files", f'["{tmp_path}/a.zst"]').option("part_bytes", 1).load()
    assert raw.select(F.spark_partition_id()).distinct().count() > 5  # several tasks read it


def test_long_lines_over_whole_parts_and_empty_files(spark, tmp_path):
    text = b"a\n" + b"y" * 5000 + b"\nb\n"
    write(tmp_path / "a.zst", text, [1000] * 6)
    write(tmp_path / "e.zst", b"", [0])
    got = sorted((x.line, len(x.value)) for x in frames.zstd_lines(spark, str(tmp_path), part_bytes=1).collect())
    assert got == [(0, 1), (1, 5000), (2, 1)]
    (tmp_path / "bad.zst").write_bytes(b"plain text, not compressed")
    with pytest.raises(Exception, match="no Zstandard frame"):
        frames.zstd_lines(spark, str(tmp_path / "bad.zst")).collect()


def test_files_are_written_in_pieces_and_parts_stay_few(spark, tmp_path):
    lines = spark.range(9000).select((F.col("id") % 3 * F.lit(2)).alias("k"), F.xxhash64("id").alias("h")).withColumn("text", F.concat_ws("\t", "h", F.lit("é")))
    path = str(tmp_path / "out")
    frames.zstd_files(lines, path, "k", ["h"], "text", 50)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["n0.zst", "n2.zst", "n4.zst"]
    want = {k: [f"{h}\té" for h in sorted(x.h for x in lines.where(F.col("k") == k).collect())] for k in (0, 2, 4)}
    for k, own in want.items():
        data = (tmp_path / "out" / f"n{k}.zst").read_bytes()
        text = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert text.decode() == "".join(f"{x}\n" for x in own)
    parts = frames._LineReader({"files": f'["{path}/n2.zst"]', "part_bytes": 1}).partitions()
    assert len(parts) > 1000 and max(len(pickle.dumps(p)) for p in parts) < 500  # a part doesn't list the frames after it
    got = frames.zstd_lines(spark, path, part_bytes=1).withColumn("p", F.spark_partition_id()).collect()
    assert len({x.p for x in got}) <= frames.CORE_PARTS * 4 + 3
    assert sorted((x.line, x.value) for x in got if x.path.endswith("n4.zst")) == list(enumerate(want[4]))
    frames.zstd_files(lines.limit(0), str(tmp_path / "none"), "k", ["h"], "text", 50)
    assert list((tmp_path / "none").iterdir()) == []


def test_line_numbers_over_splits(spark, tmp_path):
    for name, n in (("s1.tsv", 3000), ("s2.tsv", 10), ("s3.tsv", 4000)):
        (tmp_path / name).write_text("".join(f"c\t{i}\t{i + 1}\t{i * 7}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = readers.exon_sums(spark, str(tmp_path))
        assert got.count() == 7010 and got.where("sum <> line * 7").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_matrix_text_is_written_in_one_pass(spark, tmp_path):
    triples = spark.range(500).select((F.col("id") % 40 + 1).alias("row_idx"), (F.col("id") / 40).cast("int").alias("col_idx"), F.col("id").alias("v")).where("col_idx > 0")
    frames.matrix_market(triples, str(tmp_path / "mm"), " c")
    lines = "".join(p.read_text() for p in sorted((tmp_path / "mm").glob("part-*"))).splitlines()
    assert lines[:3] == ["%%MatrixMarket matrix coordinate integer general", "% c", "40\t12\t460"]
    body = [tuple(map(int, x.split("\t"))) for x in lines[3:]]
    assert body == sorted(body) and len(body) == 460
    assert len(list((tmp_path / "mm").glob("part-*"))) > 2 and not list((tmp_path / "mm").glob("_drafts*"))
    frames.matrix_market(triples.limit(0), str(tmp_path / "none"), shape=(3, 4))
    assert (tmp_path / "none" / "part-000000").read_text().splitlines()[2] == "3\t4\t0"
