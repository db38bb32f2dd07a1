"""Shards of documents, and the rows that they exchange.

The exact repeat finders work in rounds. In each, a shard sends one row for
each different key that it holds, so a key that a third of all documents hold
arrives once a shard; Spark's joins, windows and partitions find what several
shards share, and the answers are cogrouped with the shards' documents. All
rounds read the same shuffle of the documents, which Spark reuses inside one
query. Rows grow in proportion to the text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of text that one shard holds on average, and the least number of shards.
SHARD_BYTES, LEAST_SHARDS = 2 << 20, 8


def sharded(docs: DataFrame, doc_id: str, text: str, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """doc_id, tie, text and shard of each document, and the number of shards, which follows the bytes of text.

    Shards are dealt by id and text together, so rows without an id, or of one
    id, spread too. Documents come in the order of doc_id, nulls last; rows of
    equal id in that of their shards, and inside a shard of tie and text.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = max(math.ceil(size / shard_bytes), LEAST_SHARDS)
    key, body = F.col(doc_id).cast("long"), F.col(text)
    return docs.select(key.alias("doc_id"), F.xxhash64(body).alias("tie"), body.alias("text"), F.pmod(F.xxhash64(key, body), F.lit(n)).cast("int").alias("shard")), n


def in_order(table: pa.Table) -> pa.Table:
    """By doc_id, nulls last; rows of equal doc_id by tie, and equal ties by text."""
    keys = [("doc_id", "ascending"), ("tie", "ascending")]
    ties = table.select(["doc_id", "tie"]).to_pandas().duplicated().any()
    return table.sort_by([*keys, ("text", "ascending")] if ties else keys)


def ids(places: np.ndarray, table: pa.Table) -> pa.Array:
    """doc_id of the rows at the given places."""
    return table["doc_id"].combine_chunks().take(pa.array(places))


def me(table: pa.Table, n: int) -> np.ndarray:
    """The shard's number, n times."""
    return np.full(n, table["shard"][0].as_py() if len(table) else 0, np.int32)


def shared(rows: DataFrame) -> DataFrame:
    """Of rows (key, shard), each once, those whose key several shards have."""
    return rows.withColumn("_n", F.count("*").over(Window.partitionBy("key"))).where("_n > 1").drop("_n")


def per_shard(parts: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """What each shard sends first."""
    return parts.groupBy("shard").applyInArrow(lambda t: work(in_order(t)), schema)


def resume(parts: DataFrame, answers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each shard's next step, with the answers it got."""
    return parts.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(lambda t, a: work(in_order(t), a), schema)


def numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[c].to_numpy() for c in names]
