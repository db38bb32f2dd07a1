"""Zstandard text in parts of whole frames, and MatrixMarket text written in one pass: data sources of Spark's own kind."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any, BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Compressed bytes from which on a part is full, and lines of a batch.
PART_BYTES, LINES = 32 << 20, 20_000

#: Parts for each core beyond which parts grow, up to PART_BYTES; parts whose counts are broadcast; and bytes that are copied at a time.
CORE_PARTS, FEW_PARTS, COPIED = 16, 10_000, 1 << 20

#: First bytes of a frame and, but for their low half byte, of one that is skipped; fixed values of the format.
FRAME, SKIPPED = 0xFD2FB528, 0x184D2A50


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and its place there."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def frame_sizes(f: BinaryIO, size: int, at: int = 0) -> Iterator[tuple[int, int]]:
    """Start and end of each frame from a place on: headers of frames and blocks are read, what they hold is passed over."""
    import zstandard

    while at < size:
        f.seek(at)
        head = f.read(18)
        magic = int.from_bytes(head[:4], "little")
        if magic & ~0xF == SKIPPED:
            at += 8 + int.from_bytes(head[4:8], "little")
            continue
        if magic != FRAME:
            raise ValueError(f"no Zstandard frame at byte {at}")
        start, checked = at, zstandard.get_frame_parameters(head).has_checksum
        at += zstandard.frame_header_size(head)
        last = False
        while not last:
            f.seek(at)
            block = int.from_bytes(f.read(3), "little")
            last, kind = bool(block & 1), (block >> 1) & 3
            at += 3 + (1 if kind == 1 else block >> 3)  # a repeated byte is stored once
        at += 4 if checked else 0
        yield start, at


@dataclass
class Part(InputPartition):
    path: str
    number: int
    start: int
    end: int  # the part's last line may end in the frames after it


class _LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.most = json.loads(options["files"]), int(options.get("part_bytes", PART_BYTES))
        self.counted = options.get("counted") == "true"

    def partitions(self) -> Sequence[Part]:
        parts = []
        for path in self.paths:
            system, place = opened(path)
            begin, end, number = None, 0, 0
            with system.open_input_file(place) as f:
                for start, end in frame_sizes(f, f.size()):
                    begin = start if begin is None else begin
                    if end - begin >= self.most:
                        parts.append(Part(path, number, begin, end))
                        begin, number = None, number + 1
            if begin is not None:
                parts.append(Part(path, number, begin, end))
        return parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        """The part's lines with their places, or only how many they are."""
        n = 0
        for lines in self._lines(partition):
            if not self.counted:
                columns = [pa.array([partition.path] * len(lines)), pa.array([partition.number] * len(lines), pa.int32()), pa.array(range(n, n + len(lines)), pa.int64()), pa.array([x.decode() for x in lines], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "part", "n", "value"])
            n += len(lines)
        if self.counted:
            yield pa.RecordBatch.from_arrays([pa.array([partition.path]), pa.array([partition.number], pa.int32()), pa.array([n], pa.int64())], names=["path", "part", "n"])

    def _lines(self, partition: Part) -> Iterator[list[bytes]]:
        """Lines that begin in the part, or right after it; the first line of a later part is the one before's to read."""
        import zstandard

        system, place = opened(partition.path)
        out: list[bytes] = []
        with system.open_input_file(place) as f:

            def chunks() -> Iterator[tuple[bytes, bool]]:
                for inside, at, stop in ((True, partition.start, partition.end), (False, partition.end, f.size())):
                    for start, end in frame_sizes(f, stop, at):
                        f.seek(start)
                        reader = zstandard.ZstdDecompressor().stream_reader(_Limited(f, end - start))
                        while data := reader.read(1 << 20):
                            yield data, inside

            held, at, length = b"", 0, 0  # text not yet cut, its place in the part, and the part's length so far
            skipping = partition.number > 0
            done = False
            for data, inside in chunks():
                length += len(data) if inside else 0
                held += data
                while not done and (cut := held.find(b"\n")) >= 0:
                    lines = held.split(b"\n") if inside else [held[:cut], held[cut + 1 :]]
                    for line in lines[:-1]:
                        if not inside and at > length:
                            done = True
                            break
                        if skipping:
                            skipping = False
                        else:
                            out.append(line)
                        at += len(line) + 1
                        if len(out) >= LINES:
                            yield out
                            out = []
                    held = lines[-1]
                done = done or (not inside and at > length)
                if done:
                    break
            if held and not done and not skipping and at <= length:
                out.append(held)  # the file's last line, without an end
            if out:
                yield out


class _Limited:
    """The next so many bytes of a file."""

    def __init__(self, f: BinaryIO, left: int):
        self.f, self.left = f, left

    def read(self, n: int) -> bytes:
        data = self.f.read(min(n, self.left))
        self.left -= len(data)
        return data


class ZstdLines(DataSource):
    """Lines of Zstandard files: path, part, n (the line's place in the part, from 0) and value; if counted, only how many lines (n) each part has."""

    @classmethod
    def name(cls) -> str:
        return "zstd_lines"

    def schema(self) -> str:
        return "path string, part int, n long" + ("" if self.options.get("counted") == "true" else ", value string")

    def reader(self, schema: Any) -> DataSourceReader:
        return _LineReader(self.options)


def zstd_lines(spark: SparkSession, paths: str | Sequence[str], part_bytes: int = PART_BYTES) -> DataFrame:
    """path, line (from 0, true in the whole file) and value of Zstandard text, read in parts of whole frames.

    A file of one frame is one part, as nothing inside a frame can be read
    alone. Parts have part_bytes at least, and more, up to PART_BYTES, where
    that would make many for each core. How many lines each part has is counted
    first, by reading it.
    """
    spark.dataSource.register(ZstdLines)
    files = sorted((r["path"], r["length"]) for r in spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).select("path", "length").collect())
    total = sum(n for _, n in files)
    most = max(part_bytes, min(PART_BYTES, total // (CORE_PARTS * spark.sparkContext.defaultParallelism)))
    source = spark.read.format("zstd_lines").option("files", json.dumps([p for p, _ in files])).option("part_bytes", most)
    lines, counted = source.load(), source.option("counted", "true").load()
    before = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    counts = counted.select("path", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = F.broadcast(counts) if len(files) + total // most <= FEW_PARTS else counts
    return lines.join(counts, ["path", "part"]).select("path", (F.col("n") + F.col("before")).alias("line"), "value")


def zstd_files(lines: DataFrame, path: str, name: str, order: Sequence[str], value: str | Column, frame_bytes: int) -> None:
    """One Zstandard file for each value of the column name, {path}/n{name}.zst, of its lines in order, in frames of so many bytes of text.

    Lines are dealt by range of file and order, and tasks write pieces of files
    as they read them, frame by frame; then each file's pieces, whole frames,
    are copied one after the other. So no task holds a file.
    """
    spark = lines.sparkSession
    drafts = f"{path.rstrip('/')}/_drafts-{uuid.uuid4().hex}"
    system, place = opened(drafts)
    system.create_dir(place, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        system, place = opened(drafts)
        number, file, f, text = TaskContext.get().partitionId(), None, None, b""
        made = []

        def flush(least: int) -> bytes:
            at = 0
            while len(text) - at >= least and at < len(text):
                f.write(zstandard.compress(text[at : at + frame_bytes]))
                at += frame_bytes
            return text[at:]

        for b in batches:
            names = b.column(0).to_pylist()
            values = b.column(1).to_pylist()
            ends = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
            for i, j in zip([0, *ends], [*ends, len(names)], strict=True):
                if i == j:
                    continue
                if names[i] != file:
                    if f:
                        flush(1)
                        f.close()
                    file, text, draft = names[i], b"", uuid.uuid4().hex
                    f = system.open_output_stream(f"{place}/{draft}", compression=None)
                    made.append((str(file), number, draft))
                text += ("\n".join(values[i:j]) + "\n").encode()
                text = flush(frame_bytes)
        if f:
            flush(1)
            f.close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int32()), pa.array([m[2] for m in made], pa.string())], names=["file", "number", "draft"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = opened(drafts)
        for b in batches:
            for file, pieces in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with system.open_output_stream(f"{opened(path)[1].rstrip('/')}/n{file}.zst", compression=None) as out:
                    for p in pieces:
                        with system.open_input_stream(f"{place}/{p['draft']}", compression=None) as f:
                            while data := f.read(COPIED):
                                out.write(data)
            yield b.select([0])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartitionByRange(parts, name, *order).sortWithinPartitions(name, *order)
    pieces = dealt.select(name, value).mapInArrow(write, "file string, number int, draft string")
    whole = pieces.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("number", "draft"))).alias("pieces"))  # few pieces for each task
    whole.repartition(parts, "file").mapInArrow(join, "file string").collect()
    system.delete_dir(place)


@dataclass
class Written(WriterCommitMessage):
    draft: str
    name: str
    rows: int
    columns: int
    entries: int


class _MatrixWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.comment = options["path"].rstrip("/"), options.get("comment", "")
        self.shape = json.loads(options["shape"]) if options.get("shape") else None
        self.job = options["job"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        system, root = opened(self.path)
        system.create_dir(f"{root}/_drafts-{self.job}", recursive=True)
        draft = f"{root}/_drafts-{self.job}/{uuid.uuid4().hex}"
        rows = columns = entries = 0
        with system.open_output_stream(draft) as f:
            for b in iterator:
                if b.num_rows:
                    cells = [c.to_pylist() for c in b.columns]
                    f.write("".join("\t".join(map(str, r)) + "\n" for r in zip(*cells, strict=True)).encode())
                    rows, columns, entries = max(rows, max(cells[0])), max(columns, max(cells[1])), entries + b.num_rows
        return Written(draft, f"part-{TaskContext.get().partitionId() + 1:06d}", rows, columns, entries)

    def commit(self, messages: list[Written | None]) -> None:
        """Parts get their names, and what the tasks counted makes the header, which is written last and read first."""
        system, root = opened(self.path)
        done = [m for m in messages if m is not None]
        for m in done:
            if m.entries:
                system.move(m.draft, f"{root}/{m.name}")
        n, k = self.shape or (max((m.rows for m in done), default=0), max((m.columns for m in done), default=0))
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/part-000000") as f:
            f.write(f"%%MatrixMarket matrix coordinate integer general\n%{self.comment}\n{n}\t{k}\t{sum(m.entries for m in done)}\n".encode())
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = opened(self.path)
        if system.get_file_info(f"{root}/_drafts-{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{root}/_drafts-{self.job}")


class MatrixMarket(DataSource):
    """Writes triples as MatrixMarket text, in parts to be read in the order of their names."""

    @classmethod
    def name(cls) -> str:
        return "matrix_market"

    def writer(self, schema: Any, overwrite: bool) -> DataSourceArrowWriter:
        return _MatrixWriter(self.options)


def matrix_market(triples: DataFrame, path: str, comment: str = "", shape: tuple[int, int] | None = None) -> None:
    """MatrixMarket text: banner, comment, sizes, and one line for each entry, ordered by its first two columns.

    One pass: tasks count their entries and greatest indices while they write.
    Give shape where rows or columns without an entry come after the last one.
    """
    spark = triples.sparkSession
    spark.dataSource.register(MatrixMarket)
    order = triples.columns[:2]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = triples.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.format("matrix_market").mode("append")
    writer.option("comment", comment).option("shape", json.dumps(shape) if shape else "").option("job", uuid.uuid4().hex).save(path)
