"""Intervals: overlap joins by bins, sums over regions, coalescing, disjoint pieces, islands and gaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.ranges import carried, dealt, fields, inside, scanned

#: Each level's bins are so many times as long as those of the level below, and the last level's hold all that is longer.
LEVEL, LEVELS = 16, 8


def _level(bin_size: int) -> Column:
    """The lowest level whose bins are at least as long as the interval."""
    steps = F.ceil(F.log(F.greatest((F.col("end") - F.col("start")) / bin_size, F.lit(1.0))) / F.log(F.lit(float(LEVEL))) - 1e-9)
    return F.least(steps, F.lit(LEVELS)).cast("int")


def overlap_join(left: DataFrame, right: DataFrame, bin_size: int, on: Sequence[str] = ("chrom",)) -> DataFrame:
    """Pairs of half-open intervals [start, end) that overlap; right columns get the suffix _r.

    Intervals meet in the bins they touch, as an equi-join; a pair counts only
    in the bin of the later of its two starts, so it appears once. Long
    intervals have longer bins, so each touches two at most: a pair meets on
    the level of the longer one, and so a row also goes to the other side's
    higher levels. Which levels either side has, a few numbers, is read first.
    """
    sides = [t.where("end > start").withColumn("_own", _level(bin_size)) for t in (left, right)]
    have = [sorted(r[0] for r in s.select("_own").distinct().collect()) for s in sides]  # LEVELS + 1 at most

    def binned(side: DataFrame, mine: list[int], others: list[int]) -> DataFrame:
        higher = [x for x in others if mine and x > mine[0]]
        if higher or len(mine) > 1:
            levels = F.array_union(F.array("_own"), F.filter(F.array(*(F.lit(x).cast("int") for x in higher)).cast("array<int>"), lambda x: x > F.col("_own")))
            side = side.withColumn("_level", F.explode(levels)).withColumn("_size", F.lit(bin_size).cast("long") * F.pow(F.lit(LEVEL), F.col("_level")).cast("long"))
        else:  # one level for all, the usual case
            level = mine[0] if mine else 0
            side = side.withColumn("_level", F.lit(level)).withColumn("_size", F.lit(bin_size * LEVEL**level).cast("long"))
        return side.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / F.col("_size")), F.floor((F.col("end") - 1) / F.col("_size")))))

    l, r = binned(sides[0], *have), binned(sides[1], *have[::-1])
    r = r.select(*on, "_level", "_bin", F.col("_own").alias("_own_r"), *(F.col(c).alias(f"{c}_r") for c in right.columns if c not in on))
    both = l.join(r, [*on, "_level", "_bin"]).where((F.col("start") < F.col("end_r")) & (F.col("start_r") < F.col("end")))
    once = (F.col("_level") == F.greatest("_own", "_own_r")) & (F.floor(F.greatest("start", "start_r") / F.col("_size")) == F.col("_bin"))
    return both.where(once).drop("_level", "_bin", "_size", "_own", "_own_r")


def _area_events(regions: DataFrame, values: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row for each value, at its start, and two for each region, at its ends: side tells which, and is null for values."""
    place = values.where("end > start").dropna(subset=list(on))
    last = F.struct(F.col("start").alias("from"), "end", "value")
    starts = place.select(*on, F.col("start").cast("long").alias("pos"), ((F.col("end") - F.col("start")) * F.col("value")).alias("area"), last.alias("last"))
    ends = F.explode(F.array(F.struct(F.col("start").cast("long").alias("pos"), F.lit(-1).alias("side")), F.struct(F.col("end").cast("long").alias("pos"), F.lit(1).alias("side")))).alias("e")
    points = regions.select(*on, F.struct(*regions.columns).alias("region"), ends).select(*on, "e.pos", "region", "e.side")
    return starts.unionByName(points, allowMissingColumns=True)


def summarise_regions(regions: DataFrame, values: DataFrame, how: str = "mean", on: Sequence[str] = ("chrom",)) -> DataFrame:
    """Mean (over all bases, uncovered ones too) or sum of per-base values over each region; of a region of no bases null or 0.

    The value intervals must not overlap each other; see last_writer() where
    they do. A region's sum is the area before its end less that before its
    start, so the work is that of sorting values and ends, however long the
    regions are: both are dealt by range, running sums of area are carried from
    range to range, and what the last value before a place has beyond it is
    taken off. Sums of whole numbers are exact; fractional ones round as the
    running sum of their chromosome does.
    """
    rows = dealt(_area_events(regions, values, on), [*on, "pos"])
    rows = carried(rows, on, _area=(F.sum("area"), "sum"), _last=(F.max("last"), "max"))
    past = inside(on, ["pos", F.col("side").asc_nulls_last()]).rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.max("last").over(past), F.col("_last"))
    area = F.coalesce(F.sum("area").over(past), F.lit(0)) + F.coalesce("_area", F.lit(0))
    beyond = F.coalesce(last["value"] * F.greatest(F.lit(0), last["end"] - F.col("pos")), F.lit(0))
    each = rows.select("region", "side", (area - beyond).alias("_a")).where("side is not null")
    sums = each.groupBy(*(F.col(f"region.{c}").alias(c) for c in regions.columns)).agg((F.max(F.when(F.col("side") > 0, F.col("_a"))) - F.max(F.when(F.col("side") < 0, F.col("_a")))).alias("_s"), F.count("*").alias("_n"))
    size = F.col("end") - F.col("start")
    value = F.when(size > 0, F.col("_s")).otherwise(F.lit(0))
    value = F.when(size > 0, value / size) if how == "mean" else value
    return sums.select(*regions.columns, value.alias("value"), F.explode(F.array_repeat(F.lit(0), (F.col("_n") / 2).cast("int")))).drop("col")  # equal regions are as many as they were


def _sweep(on: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted pieces (keys, _range, start, end, line, value) of ranges as disjoint ones, each with the open piece of the last line.

    What is held is the open pieces of one range, on a heap by line.
    """
    import heapq

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        heap: list[tuple] = []  # (-line, number, end, value), of which ended ones go when they reach the top
        key, at, n, kinds = None, 0, 0, None

        def until(stop: int | None) -> None:
            nonlocal at
            while heap and (stop is None or at < stop):
                if heap[0][2] <= at:
                    heapq.heappop(heap)
                    continue
                _, number, end, value = heap[0]
                to = end if stop is None else min(end, stop)
                if out and out[-1][0] == (key, number) and out[-1][2] == at:
                    out[-1] = (out[-1][0], out[-1][1], to, value)
                else:
                    out.append(((key, number), at, to, value))
                at = to
            if stop is not None:
                at = stop

        def made() -> Iterator[pa.RecordBatch]:
            if out:
                keys = [o[0][0][:on] for o in out]
                columns = [*zip(*keys, strict=True)] if on else []
                columns += [[o[i] for o in out] for i in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=[str(i) for i in range(len(columns))])
                out.clear()

        for b in batches:
            types = [b.schema.field(i).type for i in range(b.num_columns)]
            kinds = [*types[:on], pa.int64(), pa.int64(), types[-1]]
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[: on + 1] != key:
                    until(None)
                    key, at = row[: on + 1], row[on + 1]
                start, end, line, value = row[on + 1 :]
                until(start)
                heapq.heappush(heap, (-line, n, end, value))
                n += 1
            yield from made()
        until(None)
        yield from made()

    return work


def last_writer(values: DataFrame, order: str = "line", on: Sequence[str] = ("chrom",)) -> DataFrame:
    """Overlapping value intervals as disjoint ones, of which later lines overwrite earlier; a line's number is a whole one.

    Intervals are dealt by range of their starts and cut at the ranges' borders,
    so that each range is swept by itself, in order of start, with its open
    intervals on a heap: rows and work grow with the intervals, not with how
    deep they lie. Neighbouring pieces of one interval may be cut at a border.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    named = values.where("end > start").dropna(subset=list(on)).select(*(F.col(c).alias(k) for c, k in zip(on, keys, strict=True)), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col(order).cast("long").alias("_line"), "value")
    rows = dealt(named.withColumn("_all", F.lit(0)), [*keys, "start"])
    borders = rows.groupBy("_all", *keys, "_p").agg(F.min("start").alias("_b")).groupBy("_all", *keys).agg(F.sort_array(F.collect_set("_b")).alias("_borders"))  # a number for each range and key
    cut = rows.join(borders, ["_all", *keys])
    bounds = F.concat(F.array("start"), F.filter("_borders", lambda b: (b > F.col("start")) & (b < F.col("end"))), F.array("end"))
    pieces = cut.withColumn("_bounds", bounds).withColumn("_i", F.explode(F.sequence(F.lit(0), F.size("_bounds") - 2)))
    start = F.get("_bounds", F.col("_i"))
    pieces = pieces.select(*keys, F.size(F.filter("_borders", lambda b: b <= start)).alias("_range"), start.alias("start"), F.get("_bounds", F.col("_i") + 1).alias("end"), "_line", "value")
    types = dict(pieces.dtypes)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "start long", "end long", f"value {types['value']}"])
    swept = pieces.repartition(*keys, "_range").sortWithinPartitions(*keys, "_range", "start").mapInArrow(_sweep(len(on)), schema)
    return swept.withColumnsRenamed(dict(zip(keys, on, strict=True)))


def mark_counts(regions: DataFrame, marks: DataFrame, on: Sequence[str] = ("chrom", "strand")) -> DataFrame:
    """How many marked bases (chrom, pos, strand), counted from 0, each region of the same strand holds, its last base aside."""
    points = marks.select(*on, F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), F.lit(1).cast("long").alias("value")).distinct()
    counted = summarise_regions(regions.withColumn("end", F.col("end") - 1), points, "sum", on)
    return counted.withColumn("end", F.col("end") + 1)


def _islands(rows: DataFrame, on: Sequence[str], order: Sequence[str], new: Column) -> DataFrame:
    """Dealt rows with _island, the first of the order's values of the run each belongs to; new tells a run's first row."""
    marked = rows.withColumn("_begin", F.when(new, F.col(order[0])))
    known = carried(marked, on, _from=(F.max("_begin"), "max"))
    return known.withColumn("_island", F.coalesce(F.max("_begin").over(inside(on, order).rowsBetween(Window.unboundedPreceding, 0)), "_from"))


def coalesce(intervals: DataFrame, gap: int = 2, on: Sequence[str] = ("chrom",)) -> DataFrame:
    """Closed intervals merged wherever the gap to what came before is below gap; those without a start or end are left out.

    Blocks of sorted rows are merged by themselves. Of a block's results the
    first ones may belong to an interval of earlier blocks: those that begin
    below their reach.
    """

    def merged(t: pa.Table, key: np.ndarray) -> pa.Table:
        start, end = t["start"].to_numpy(), t["end"].to_numpy()
        far = pd.Series(end).groupby(key).cummax().to_numpy()
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (start[1:] - far[:-1] >= gap)
        first = np.flatnonzero(new)
        out = t.take(pa.array(first))
        return out.set_column(out.schema.get_field_index("end"), "end", pa.array(np.maximum.reduceat(end, first)))

    rows = intervals.select(*on, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).dropna(subset=["start", "end"])
    runs = carried(scanned(rows, on, ("start", "end"), merged, f"{fields(rows, on)}start long, end long"), on, _reach=(F.max("end"), "max"))
    runs = runs.withColumn("_begin", F.when(F.col("_reach").isNull() | (F.col("start") - F.col("_reach") >= gap), F.col("start")))
    known = carried(runs, on, _from=(F.max("_begin"), "max"))
    return known.groupBy(*on, F.coalesce("_begin", "_from").alias("_island")).agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def disjoin(intervals: DataFrame, on: Sequence[str] = ("chrom",)) -> DataFrame:
    """The pieces that all bounds of closed intervals cut the covered bases into.

    Each interval adds one to the depth at its start and takes it off after its
    end; a piece lies between neighbouring cuts where the depth is above zero.
    Depths and neighbours are found inside blocks of sorted cuts; a block's
    first depth and last neighbour come from the blocks around it.
    """

    def pieces(t: pa.Table, key: np.ndarray) -> pa.Table:
        start = t["start"].to_numpy()
        depth = pd.Series(t["step"].to_numpy()).groupby(key).cumsum().to_numpy()
        last = np.ones(len(key), bool)
        last[:-1] = key[1:] != key[:-1]
        return t.append_column("depth", pa.array(depth)).append_column("next", pa.array(np.append(start[1:], 0), mask=last))

    cuts = intervals.select(*on, F.explode(F.array(F.struct(F.col("start").cast("long").alias("at"), F.lit(1).cast("long").alias("step")), F.struct((F.col("end") + 1).cast("long").alias("at"), F.lit(-1).cast("long").alias("step")))).alias("c")).where("c.at is not null")
    steps = cuts.groupBy(*on, F.col("c.at").alias("start")).agg(F.sum("c.step").alias("step"))
    rows = scanned(steps, on, ["start"], pieces, f"{fields(steps, on)}start long, step long, depth long, next long")
    rows = carried(carried(rows, on, _before=(F.sum("step"), "sum")), on, back=True, _after=(F.min("start"), "min"))
    end = F.coalesce("next", "_after") - 1
    return rows.where(F.col("depth") + F.coalesce("_before", F.lit(0)) > 0).select(*on, "start", end.alias("end"))


def _positions(positions: DataFrame, position: str, on: Sequence[str]) -> DataFrame:
    """Different positions p of each key with the one before, dealt by range."""
    rows = carried(dealt(positions.select(*on, F.col(position).alias("p")).distinct(), [*on, "p"]), on, _last=(F.max("p"), "max"))
    return rows.withColumn("_previous", F.coalesce(F.lag("p").over(inside(on, ["p"])), "_last")).drop("_last")


def islands(positions: DataFrame, position: str, on: Sequence[str] = ()) -> DataFrame:
    """Runs of consecutive positions as first, last and a range text such as 3-7."""
    rows = _positions(positions, position, on)
    runs = _islands(rows, on, ["p"], F.col("_previous").isNull() | (F.col("p") - F.col("_previous") > 1))
    grouped = runs.groupBy(*on, "_island").agg(F.min("p").alias("first"), F.max("p").alias("last")).drop("_island")
    text = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", F.col("first").cast("string"), F.col("last").cast("string")))
    return grouped.withColumn("range", text)


def gaps(positions: DataFrame, position: str, on: Sequence[str] = ()) -> DataFrame:
    """The ranges between runs of consecutive positions."""
    return _positions(positions, position, on).select(*on, (F.col("_previous") + 1).alias("first"), (F.col("p") - 1).alias("last")).where("first <= last")
