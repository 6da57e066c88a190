import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanmill.llm import topk


def by_force(rows, k, every):
    vectors = {}
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors[vec_id] = [math.floor(256 * float(x)) for x in v]
    out = set()
    for q, a in vectors.items():
        if q % every == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b)), i)
                for i, b in vectors.items()
                if i != q and len(b) == len(a)
            )
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def found(vectors, every, k=5):
    return {tuple(r) for r in topk.nearest(vectors, F.col("vec_id") % every == 0, k).collect()}


def test_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert found(vectors, 50) == by_force(rows, 5, 50)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(topk, "VECTORS", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)


def test_edges(spark, small_blocks):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 6).tolist()) for i in range(150)]
    rows += [(200 + i, [0.5] * 6) for i in range(90)]  # one vector many times
    rows += [(400, None), (401, [0.5, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] + [0.5] * 5)]
    rows += [(403, [float("inf")] + [0.5] * 5), (404, [0.1, 0.2]), (406, [0.3, 0.1]), (None, [0.5] * 6)]
    rows += [(408, []), (410, [0.0] * 6), rows[0], rows[0]]
    data = [(i, v, 1, 2) for i, v in rows]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, block int")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert found(vectors, 2) == by_force(exact, 5, 2)


def test_large_components(spark, small_blocks):
    rows = [(i, [float(3e9 + 7 * i), float(-1e9 * i)]) for i in range(12)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    small = spark.createDataFrame([(i, [v[0] / 1e6, v[1] / 1e6]) for i, v in rows], vectors.schema)
    assert found(small, 3) == by_force([(r.vec_id, r.embedding) for r in small.collect()], 5, 3)
    with pytest.raises(Exception, match="too large|OverflowError|int64"):
        found(spark.createDataFrame([(i, [1e13 + i]) for i in range(3)], vectors.schema), 1)


def test_no_side_is_broadcast(spark, small_blocks):
    """Small rows make large blocks: Spark would take them to be small."""
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, 1, 6).tolist()) for i in range(120)]
    best = topk.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 2 == 0)
    assert {tuple(r) for r in best.collect()} == by_force(rows, 5, 2)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_no_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.nearest(none, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(50, [0.1])], none.schema)
    assert topk.nearest(one, F.col("vec_id") % 50 == 0).count() == 0


def test_few_exact_vectors_are_read():
    """Bounds leave little to read: the point of the approximation."""
    rng = np.random.default_rng(1)
    exact = np.floor(256 * rng.normal(0, 0.12, (2000, 64)))
    low, width = exact.min(), max((exact.max() - exact.min() + 1) / topk.CELLS, 1.0)

    class Counting(np.ndarray):
        read = 0

        def __getitem__(self, key):
            Counting.read += len(np.atleast_1d(key)) if not isinstance(key, slice) else 0
            return super().__getitem__(key)

    cells = topk.approximated(exact, low, width)
    topk.block_best(np.array([-1]), exact[:1], np.arange(2000), cells, exact.view(Counting), low, width, 5)
    assert Counting.read < 400
