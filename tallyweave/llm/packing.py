"""Best-fit packing of tokenised documents into sequences of a fixed length.

Tokenising is one pass over the documents. Its small rows, one for each piece,
are dealt into lanes of a bounded size; each lane packs its pieces online, in
order of arrival but for a short look-ahead in which the longest goes first,
into a bounded number of open sequences. A bitset has bit f set while some open
sequence has f tokens free, so the best fit for a piece is the lowest set bit
at or above its length. When a piece fits nowhere and all places are taken,
the fullest open sequence is closed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import durable, textops
from tallyweave.llm.wordtokens import WordTokenizer

#: Pieces that one lane packs, sequences that it keeps open meanwhile, and pieces that it looks ahead.
LANE_PIECES, OPEN_BINS, LOOK_AHEAD = 32_768, 512, 1_024

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_TOKENIZERS: dict[str, WordTokenizer] = {}  # one for each file and Python worker


def _slices(texts: list, most: int = 1 << 20) -> Iterator[slice]:
    """Runs of texts of about a million characters, or one longer text."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(at, i)
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield slice(at, len(texts))


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Each document's ids and an end id, cut into pieces of at most size tokens.

    A null or empty text has no ids: its only token is the end id. Every row is
    cut by itself, so null and repeated doc_ids give pieces like any other. An
    empty table has no pieces; columns other than id and text are ignored, and a
    long text is encoded whole by one task. keep_ids adds the ids of each piece
    as little-endian unsigned 32-bit binary.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _TOKENIZERS.get(tokenizer) or _TOKENIZERS.setdefault(tokenizer, WordTokenizer(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids = b.column(0).to_pylist()
            for part in _slices(texts):
                rows = []
                for doc, data in zip(ids[part], words.encode(texts[part]), strict=True):
                    data = data.tobytes() + end
                    for k in range(0, len(data), 4 * size):
                        piece = data[k : k + 4 * size]
                        rows.append((doc, k // (4 * size), k // 4, len(piece) // 4, zlib.crc32(piece), *([piece] if keep_ids else [])))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=False)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(cols)])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(textops.light(cut), PIECES + (", ids binary" if keep_ids else ""))


class OpenBins:
    """Open sequences in a bitset keyed by free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open, self.made, self.bits = size, most, 0, 0, 0
        self.free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, f: int) -> int:
        at = self.free[f].pop()
        if not self.free[f]:
            self.bits ^= 1 << f
        self.open -= 1
        return at

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that a piece goes to and its place there."""
        fits = self.bits >> length
        if fits:
            f = (fits & -fits).bit_length() - 1 + length
            at = self._take(f)
        else:
            f, at = self.size, self.made
            self.made += 1
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        rest = f - length
        if rest:
            if not self.free[rest]:
                self.bits |= 1 << rest
            self.free[rest].append(at)
            self.open += 1
        return at, self.size - f


def place_all(lengths: list[int], size: int, open_bins: int = OPEN_BINS, look_ahead: int = LOOK_AHEAD) -> np.ndarray:
    """Sequence and offset of each piece: pieces arrive in the given order, and of the next look_ahead the longest is placed first."""
    bins, placed = OpenBins(size, open_bins), np.zeros((len(lengths), 2), np.int64)
    for s in range(0, len(lengths), look_ahead):
        for i in sorted(range(s, min(s + look_ahead, len(lengths))), key=lambda i: -lengths[i]):
            placed[i] = bins.place(lengths[i])
    return placed


def pack(pieces: DataFrame, size: int = 2048, lane_pieces: int = LANE_PIECES, open_bins: int = OPEN_BINS, look_ahead: int = LOOK_AHEAD) -> DataFrame:
    """Give each piece a sequence_id and its offset there.

    Pieces arrive in the order of doc_id (nulls last), piece and crc. They are
    written to the checkpoint folder first, so that a task that runs again sees
    the same rows. Equal rows are packed one by one, and however many there are
    they spread over the lanes. No pieces, no sequences.
    """
    pieces = durable.checkpoint(pieces)
    lanes = max(1, -(-pieces.count() // lane_pieces))

    def fill(table: pa.Table) -> pa.Table:
        lane = table["lane"][0].as_py()
        table = table.drop_columns("lane").sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        placed = place_all(table["length"].to_pylist(), size, open_bins, look_ahead)
        return table.append_column("sequence_id", pa.array(placed[:, 0] + (lane << 32))).append_column("offset", pa.array(placed[:, 1]))

    lane = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(lanes)).cast("int").alias("lane")
    kinds = ", ".join(f"{c} {t}" for c, t in pieces.dtypes)
    return pieces.select("*", lane).groupBy("lane").applyInArrow(fill, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, **names) -> DataFrame:
    """Tokenise and pack: one row for each piece, with its sequence and offset."""
    return pack(token_pieces(docs, tokenizer, size, **names), size)
