"""Exact nearest vectors by inner product, with a vector-approximation file.

Components are cut into cells of one width, and a file of blocks of vectors
keeps a byte per cell beside the exact integers. A query's product with the
middles of a vector's cells, give or take half a cell times the query's
absolute sum, bounds its exact score. A block is scanned by its cells, and exact
vectors are read in the order of their bounds until no bound left can still
reach the k-th score. Each block answers with k rows a query at most, and those
are merged.

Queries travel in blocks, every block of queries to every block of vectors:
the work that an exact answer for a growing set of queries needs. No side is
broadcast or held whole, and equal vectors are read only as far as ties go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanmill.llm.common import staged

VECTORS, QUERIES = 8192, 1024
CELLS = 256
#: Doubles hold integers up to here exactly.
EXACT = 2.0**53


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * component) as whole doubles.

    Vectors that are NULL, without an id, or hold a NULL, NaN or infinite
    component take no part. Other columns are dropped.
    """
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return vectors.filter("vec_id is not null and embedding is not null").filter(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")
    )


def _packed(rows: DataFrame, block: Column, name: str, low: float, width: float) -> DataFrame:
    """One row per block and dimension: ids, cells and exact values, by id."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix = flat.reshape(len(ids), -1)[order]
        return pa.table(
            {
                name: table.column("block").slice(0, 1),
                f"{name}_dim": table.column("dim").slice(0, 1),
                f"{name}_ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                f"{name}_cells": pa.array([approximated(matrix, low, width).tobytes()], pa.binary()),
                f"{name}_exact": pa.array([matrix.astype("<f8").tobytes()], pa.binary()),
            }
        )

    keyed = rows.withColumns({"block": block.cast("int"), "dim": F.size("v")})
    return keyed.groupBy("block", "dim").applyInArrow(
        run, f"{name} int, {name}_dim int, {name}_ids binary, {name}_cells binary, {name}_exact binary"
    )


def approximated(exact: np.ndarray, low: float, width: float) -> np.ndarray:
    return np.clip(np.floor((exact - low) / width), 0, CELLS - 1).astype(np.uint8)


def whole(x: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python's integers, which do not round."""
    out = np.empty(x.shape, object)
    out.ravel()[:] = [int(v) for v in x.ravel()]
    return out


def block_best(
    q_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    cells: np.ndarray,
    exact: np.ndarray,
    low: float,
    width: float,
    k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector and score of each query's k best in one block of vectors,
    which are in order of id."""
    middles = low + (cells.astype(np.float64) + 0.5) * width
    bounds = queries @ middles.T
    # Half a cell in each dimension, and what rounding of these products may add.
    reach = np.abs(queries).sum(1) * (width / 2)
    reach += 1e-9 * (np.abs(queries) @ np.abs(middles).max(0, initial=0) + 1)
    largest = max(abs(low), abs(low + CELLS * width))
    if largest * np.abs(queries).sum(1).max(initial=0) >= EXACT:  # beyond doubles
        exact, queries = whole(exact), whole(queries)
    out: tuple[list, list, list] = ([], [], [])
    for row, q_id in enumerate(q_ids):
        upper = bounds[row] + reach[row]
        upper[np.searchsorted(ids, q_id, "left") : np.searchsorted(ids, q_id, "right")] = -np.inf
        able = int((upper > -np.inf).sum())
        if not able:
            continue
        take, best = min(able, 4 * k), None
        while True:
            some = np.argpartition(-upper, take - 1)[:take] if take < len(upper) else np.arange(len(upper))
            some = np.sort(some[upper[some] > -np.inf])
            scores = exact[some] @ queries[row]
            best = np.lexsort((ids[some], -scores))[:k]
            rest = upper.copy()
            rest[some] = -np.inf
            # Certain once no vector left can reach the k-th score.
            if take >= able or (len(best) == k and rest.max() < scores[best[-1]]):
                break
            if len(best) == k:
                take = max(take + 1, int((upper >= scores[best[-1]]).sum()))
            else:
                take *= 2
            take = min(take, able)
        out[0].extend([int(q_id)] * len(best))
        out[1].extend(ids[some[best]].tolist())
        out[2].extend(int(s) for s in scores[best])
    return tuple(np.array(x, np.int64) for x in out)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """For each vector with ``is_query`` (over vec_id) the k other vectors with
    the highest inner product of their integers, all if there are fewer:
    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``. Ties go to the smaller
    id. Vectors of another length are never compared. Rows that share an id are
    one vector if they are equal, and candidates each if they are not; no row is
    its own id's neighbour. A score beyond 64 bits is an error.
    """
    rows = staged(integers(vectors, scale).distinct(), "integers")
    n, low, high = rows.agg(
        F.count("*"), F.min(F.array_min("v")), F.max(F.array_max("v"))
    ).first()
    schema = "query_id long, vec_id long, score long"
    if not n or low is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max((high - low + 1) / CELLS, 1.0)
    asked = rows.filter(is_query)
    blocks = -(-n // VECTORS)
    query_blocks = max(1, -(-asked.count() // QUERIES))

    def block(number: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "v"), F.lit(number))

    file = _packed(rows, block(blocks), "file", low, width).withColumnRenamed("file", "block")
    asking = _packed(asked, block(query_blocks), "asked", low, width).drop("asked_cells").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    # The size that Spark takes the queries to have is that of their rows before
    # they are packed and go to every block: by it they would be broadcast.
    pairs = asking.hint("merge").join(file, "block").filter("asked_dim = file_dim")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                def read(name: str, dtype: str, at: int = row) -> np.ndarray:
                    return np.frombuffer(batch.column(name)[at].as_py(), dtype)

                asked, ids = read("asked_ids", "<i8"), read("file_ids", "<i8")
                found = block_best(
                    asked,
                    read("asked_exact", "<f8").reshape(len(asked), -1),
                    ids,
                    read("file_cells", "u1").reshape(len(ids), -1),
                    read("file_exact", "<f8").reshape(len(ids), -1),
                    low,
                    width,
                    k,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"]
                )

    best = pairs.mapInArrow(run, schema).distinct()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
