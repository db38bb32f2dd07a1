import math
import random

import pytest
from pyspark.sql import functions as F

from tallyweave.llm import nearest


def brute(rows, k):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    dot = lambda a, b: __import__("functools").reduce(lambda s, p: s + p[0] * p[1], zip(a, b, strict=True), 0.0)
    out = []
    for q, v in good:
        if q % 5 == 0:
            near = sorted((-dot(v, w) / (math.sqrt(dot(v, v)) * math.sqrt(dot(w, w))), i) for i, w in good if i != q and len(w) == len(v))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 8192])
def test_equals_brute_force(spark, block):
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, 0.5, 0.25, 2.0, 0.0]) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(30)]  # equal vectors
    rows += [(200, None), (205, []), (210, [0.0] * 6), (215, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (220, [float("nan")] * 6), (225, [float("inf")] * 6), (None, [1.0] * 6), (230, [1.0, 2.0]), (231, [2.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, g string, near string")
    got = sorted(map(tuple, nearest.nearest(df, F.col("vec_id") % 5 == 0, k=4, block=block, query_block=block).collect()))
    want = brute(rows, 4)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert [x[3] for x in got] == pytest.approx([x[3] for x in want], abs=1e-15)


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest.nearest(none, F.col("vec_id") % 5 == 0).count() == 0
    one = spark.createDataFrame([(5, [1.0])], none.schema)
    assert nearest.nearest(one, F.col("vec_id") % 5 == 0).count() == 0
