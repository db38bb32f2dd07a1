"""Joins for metadata: padded outer joins, look-ups that must hit, filters by another table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave import folders


def padded_join(small: DataFrame, large: DataFrame, key: str, how: str = "full") -> DataFrame:
    """Join with the small side's columns first; columns of both sides come from the small one, and misses are ''.

    how is full, left, right or inner; repeated keys give all their pairs.
    """
    own = [c for c in large.columns if c not in small.columns]
    joined = small.join(large.select(key, *own), key, {"full": "full_outer"}.get(how, how))
    return joined.select(key, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in [*(c for c in small.columns if c != key), *own]))


def must_match(rows: DataFrame, table: DataFrame, on: Sequence[str], what: str = "rows") -> DataFrame:
    """Inner join that fails if a row finds no partner."""
    if missing := rows.join(table, list(on), "left_anti").take(1):
        raise ValueError(f"{what} without a match, such as {missing[0]}")
    return rows.join(table, list(on))


#: Words that become an expression; a longer list is joined.
WORDS = 10_000


def filter_by(rows: DataFrame, column: str, words: DataFrame, word: str, delimiter: str | None = None, field: int | None = None, exclude: bool = False, repeat: bool = False, ignore_case: bool = False) -> DataFrame:
    """Rows of which the column, or one of its delimited parts, is among the words.

    field takes one part only; exclude gives the others; repeat gives a row
    once for each time that its word is listed.
    """
    fold = F.lower if ignore_case else (lambda c: c)
    text = fold(F.col(column))
    table = words.select(fold(F.col(word)).alias("_w"))
    if delimiter is None:
        keyed = rows.withColumn("_w", text)
        return keyed.join(table if repeat else table.distinct(), "_w", "inner" if repeat else "left_anti" if exclude else "left_semi").drop("_w")
    parts = F.split(text, delimiter)
    if field is not None:
        return filter_by(rows.withColumn("_p", F.get(parts, F.lit(field))), "_p", table, "_w", exclude=exclude, repeat=repeat).drop("_p")
    if repeat:
        return rows.withColumn("_w", F.explode(F.array_distinct(parts))).join(table, "_w").drop("_w")
    few = [r[0] for r in table.where("_w is not null").distinct().limit(WORDS + 1).collect()]
    if len(few) <= WORDS:
        hit = F.coalesce(F.arrays_overlap(parts, F.array(*map(F.lit, few)).cast("array<string>")), F.lit(False))
        return rows.where(~hit if exclude else hit)
    keyed = folders.rewritten(rows.withColumn("_id", F.monotonically_increasing_id()), "filtered")
    split = F.split(fold(F.col(column)), delimiter)
    hits = keyed.select("_id", F.explode(F.array_distinct(split)).alias("_w")).join(table.distinct(), "_w").select("_id").distinct()
    return keyed.join(hits, "_id", "left_anti" if exclude else "left_semi").drop("_id")


#: Patterns that one expression or automaton holds, and rows that a block of a search with more of them holds.
PATTERNS, BLOCK_ROWS = 10_000, 100_000


def _kept(rows: DataFrame, ids: DataFrame, exclude: bool) -> DataFrame:
    return rows.join(ids.select("_id").distinct(), "_id", "left_anti" if exclude else "left_semi").drop("_id")


def _cells(rows: DataFrame, column: str, patterns: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Texts (_id, _t) and patterns (_w), each once in every cell of a shard of patterns and a block of rows."""
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    texts = rows.select("_id", F.col(column).cast("string").alias("_t")).where("_t is not null").withColumn("_b", F.pmod(F.xxhash64("_id"), F.lit(blocks))).withColumn("_s", every(shards))
    words = patterns.withColumn("_s", F.pmod(F.xxhash64("_w"), F.lit(shards))).withColumn("_b", every(blocks))
    return texts, words


#: Regular expressions of plain text, of which signs may be escaped, with or without anchors; and the line's end that a text's last line may have.
PLAIN, LAST_END = r"(?s)^(\^?)((?:[^\\^$.|?*+()\[\]{}]|\\[^A-Za-z0-9])*)(\$?)$", r"(?:\r\n|[\n\r\u0085\u2028\u2029])\z"


def _plain(words: DataFrame) -> DataFrame:
    """Patterns (_w) with the plain text _l that they are, null if they are more, and whether it stands at a text's beginning (_at) or end (_to)."""
    part = lambda i: F.regexp_extract("_w", PLAIN, i)
    plain = F.regexp_like("_w", F.lit(PLAIN))
    return words.select("_w", F.when(plain, F.regexp_replace(part(2), r"(?s)\\(.)", "$1")).alias("_l"), (plain & (part(1) != "")).alias("_at"), (plain & (part(3) != "")).alias("_to"))


def _anchored(texts: DataFrame, words: DataFrame) -> DataFrame:
    """_id of texts (_id, _t) that begin with, end with or are a plain text, by equality of what stands there.

    As for `$`, a text also ends before the end of its last line.
    """
    lengths: dict[tuple[bool, bool], list[int]] = {}
    for at, to, n in words.select("_at", "_to", F.length("_l")).distinct().collect():  # small numbers, a few for each kind
        lengths.setdefault((at, to), []).append(n)

    def stands(t: Column, at: bool, to: bool) -> Column:
        if at and to:
            return F.filter(F.array(t), lambda x: F.array_contains(F.lit(sorted(lengths[at, to])), F.length(x)))
        each = F.filter(F.lit(sorted(lengths[at, to])), lambda n: n <= F.length(t))
        return F.transform(each, lambda n: F.left(t, n) if at else F.right(t, n))

    ends = texts.withColumn("_t", F.explode(F.array_distinct(F.array("_t", F.regexp_replace("_t", LAST_END, "")))))
    kinds = [ends.select("_id", F.explode(stands(F.col("_t"), *k)).alias("_l"), F.lit(k[0]).alias("_at"), F.lit(k[1]).alias("_to")) for k in lengths]
    return reduce(DataFrame.unionByName, kinds).join(words.select("_l", "_at", "_to").distinct(), ["_l", "_at", "_to"], "left_semi").select("_id")


def filter_by_patterns(rows: DataFrame, column: str, patterns: DataFrame, pattern: str, exclude: bool = False, most: int = 1000) -> DataFrame:
    """Rows that some regular expression matches. A null text matches none.

    Up to `most` different patterns are one expression in the scan. Of more,
    those that are plain text with an anchor are joined by equality, and those
    without one are sought by automata. The rest are joined to one expression
    for each `most`, inside tasks, and these meet the rows in blocks, which is
    work for each row and pattern; no list of patterns comes to the driver.
    """
    words = patterns.select(F.col(pattern).cast("string").alias("_w")).where("_w is not null").distinct()
    few = [r[0] for r in words.limit(most + 1).collect()]
    if not few:
        return rows if exclude else rows.limit(0)
    if len(few) <= most:
        hit = F.coalesce(F.col(column).rlike("|".join(f"(?:{p})" for p in sorted(few))), F.lit(False))
        return rows.where(~hit if exclude else hit)
    keyed = folders.rewritten(rows.withColumn("_id", F.monotonically_increasing_id()), "filtered")
    words = folders.rewritten(_plain(words), "patterns")
    texts = keyed.select("_id", F.col(column).cast("string").alias("_t")).where("_t is not null")
    anchored, loose, others = words.where("_at or _to"), words.where("_l is not null and not _at and not _to"), words.where("_l is null")
    n = words.select(*(F.count(F.when(c, 1)).alias(k) for k, c in (("anchored", F.expr("_at or _to")), ("others", F.col("_l").isNull()), ("all", F.lit(True))))).first()
    hits = []
    if n["anchored"]:
        hits.append(_anchored(texts, anchored))
    if n["others"]:
        split, cells = _cells(keyed, column, others.select("_w"), -(-n["others"] // most))
        whole = cells.groupBy("_s", "_b").agg(F.concat_ws("|", F.transform(F.collect_list("_w"), lambda p: F.concat(F.lit("(?:"), p, F.lit(")")))).alias("_w"))  # about `most` each
        hits.append(split.join(whole, ["_s", "_b"]).where(F.regexp_like("_t", F.col("_w"))).select("_id"))
    if n["anchored"] + n["others"] < n["all"]:
        hits.append(filter_by_literals(texts.withColumnRenamed("_id", "_own"), "_t", loose, "_l").select(F.col("_own").alias("_id")))
    return _kept(keyed, reduce(DataFrame.unionByName, hits), exclude)


def _automaton(words: Iterable[str]) -> Any:
    import ahocorasick

    a = ahocorasick.Automaton()
    for w in words:
        a.add_word(w, 1)
    a.make_automaton()
    return a


def _holds(automaton: Any, text: str | None) -> bool:
    return text is not None and next(automaton.iter(text), None) is not None


def filter_by_literals(rows: DataFrame, column: str, words: DataFrame, word: str, exclude: bool = False, ignore_case: bool = False, most: int = PATTERNS) -> DataFrame:
    """Rows whose text holds some of the words anywhere; one pass over a text finds them all, by an Aho-Corasick automaton.

    Up to `most` words are one automaton in every task. More are dealt into
    shards of about as many, each with an automaton of its own, which meet the
    rows in blocks. An empty word is in every text, a null one in none, and a
    null text holds none.
    """
    fold = F.upper if ignore_case else (lambda c: c)
    table = words.select(fold(F.col(word).cast("string")).alias("_w")).where("_w is not null").distinct()
    few = [r[0] for r in table.limit(most + 1).collect()]
    if not few:
        return rows if exclude else rows.limit(0)
    if "" in few or len(few) > most and table.where("_w = ''").take(1):
        any_text = F.col(column).isNotNull()
        return rows.where(~any_text if exclude else any_text)
    if len(few) <= most:

        @F.pandas_udf("boolean")
        def found(texts: pd.Series) -> pd.Series:
            automaton = _automaton(few)
            return texts.map(lambda t: _holds(automaton, t)).astype(bool)

        hit = found(fold(F.col(column).cast("string")))
        return rows.where(~hit if exclude else hit)

    def search(texts: pa.Table, own: pa.Table) -> pa.Table:
        automaton = _automaton(own["_w"].to_pylist()) if own.num_rows else None
        hits = [i for i, t in zip(texts["_id"].to_pylist(), texts["_t"].to_pylist(), strict=True) if automaton and _holds(automaton, t)]
        return pa.table({"_id": pa.array(hits, pa.int64())})

    keyed = folders.rewritten(rows.withColumn("_id", F.monotonically_increasing_id()), "filtered")
    texts, cells = _cells(keyed, column, table, -(-table.count() // most))
    texts = texts.withColumn("_t", fold(F.col("_t")))
    return _kept(keyed, texts.groupBy("_s", "_b").cogroup(cells.groupBy("_s", "_b")).applyInArrow(search, "_id long"), exclude)


def first_match(rows: DataFrame, table: DataFrame, keys: Sequence[str], key: str, value: str) -> DataFrame:
    """The table's value for the first of several key columns that it has."""
    for i, k in enumerate(keys):
        rows = rows.join(table.select(F.col(key).alias(k), F.col(value).alias(f"_v{i}")), k, "left")
    return rows.withColumn(value, F.coalesce(*(f"_v{i}" for i in range(len(keys))))).drop(*(f"_v{i}" for i in range(len(keys))))


def ready(done: DataFrame, expected: DataFrame, study: str) -> DataFrame:
    """Studies of which as many samples are done as are expected."""
    a = done.groupBy(study).agg(F.count("*").alias("n"))
    b = expected.groupBy(study).agg(F.count("*").alias("n"))
    return a.join(b, [study, "n"])
