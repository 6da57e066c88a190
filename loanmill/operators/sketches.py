"""Summaries that are stored by day and merged: quantiles and distinct values.

A day's sketch has a few kilobytes at any number of rows. Merged sketches are
as good as one of all days, so no day is read again. Quantiles (KLL) are off by
a share of all rows, distinct counts (HyperLogLog) by a share of the count.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Size of quantile sketches, and how far their ranks may be off, as a share of
#: the rows: three times the published error at 99 % of this size.
KLL_K, KLL_ERROR = 2048, 0.006
#: 2**15 registers: a standard error of 0.6 % of the count.
HLL_BITS = 15
#: Rows among which a quantile is looked up in the end.
FEW = 10_000
#: Quartiles, and the fences' distance in quartile ranges.
QUARTILES, FENCE = (0.25, 0.5, 0.75), 1.5


# ------------------------------------------------------------------- quantiles


def quantile_sketches(df: DataFrame, columns: list[str], *keep: str, k: int = KLL_K) -> DataFrame:
    """A sketch and the number of values for each column, per ``keep``."""
    return df.groupBy(*keep).agg(
        *[
            agg
            for c in columns
            for agg in (
                F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"sketch_{c}"),
                F.count(c).alias(f"n_{c}"),
            )
        ]
    )


def merged_quantiles(sketches: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """Sketches of several days as one, per ``keep``."""
    return sketches.groupBy(*keep).agg(
        *[
            agg
            for c in columns
            for agg in (
                F.kll_merge_agg_double(f"sketch_{c}").alias(f"sketch_{c}"),
                F.sum(f"n_{c}").alias(f"n_{c}"),
            )
        ]
    )


def quantile(column: str, share: float) -> Column:
    """A quantile from a column's sketch."""
    return F.kll_sketch_get_quantile_double(f"sketch_{column}", F.lit(float(share)))


def exact_quantiles(df: DataFrame, column: str, shares: tuple[float, ...] = QUARTILES) -> dict[float, float]:
    """The values at ranks ceil(share * n) of a column, NULLs left out.

    A sketch brackets each rank, rows below the bracket are counted, and what
    lies in it is sketched again until few values are left: the largest of them
    that come to the driver are ``FEW`` distinct ones with their counts. Each
    pass keeps about a hundredth of the rows.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    n = values.count()
    found = {}
    for share in shares:
        if not n:
            found[share] = None
            continue
        rank, rows, size = max(1, -int(-share * n // 1)), values, n
        while True:
            few = rows.groupBy("v").agg(F.count("*").alias("n")).limit(FEW + 1).collect()
            if len(few) <= FEW:
                break
            at, off = rank / size, KLL_ERROR + 1 / size
            low, high = (
                rows.agg(F.kll_sketch_agg_double("v", KLL_K).alias("sketch_v"))
                .select(quantile("v", max(0.0, at - off)), quantile("v", min(1.0, at + off)))
                .first()
            )
            below, within = rows.agg(
                F.count_if(F.col("v") < low), F.count_if(F.col("v").between(low, high))
            ).first()
            if not below < rank <= below + within or within == size:
                break  # the sketch was off by more, or cannot tell values apart
            rows, rank, size = rows.filter(F.col("v").between(low, high)), rank - below, within
        if len(few) > FEW:
            found[share] = _at_rank(rows, rank)
            continue
        for value, count in sorted((r.v, r.n) for r in few):
            rank -= count
            if rank <= 0:
                found[share] = value
                break
    return found


def _at_rank(rows: DataFrame, rank: int) -> float:
    """The value at a rank by a sort of distinct values with their counts; the
    way that does not depend on a sketch."""
    ranges = rows.groupBy("v").agg(F.count("*").alias("n")).repartitionByRange("v")
    ranges = ranges.withColumn("task", F.spark_partition_id())
    sums = {r.task: r.n for r in ranges.groupBy("task").agg(F.sum("n").alias("n")).collect()}
    for task in sorted(sums):
        if rank <= sums[task]:
            upto = F.sum("n").over(W.partitionBy("task").orderBy("v"))
            held = ranges.filter(F.col("task") == task).withColumn("upto", upto)
            return held.filter(F.col("upto") >= rank).agg(F.min("v")).first()[0]
        rank -= sums[task]
    raise ValueError("no such rank")


def fences(quartiles: Mapping[float, float], factor: float = FENCE) -> tuple[float, float]:
    """Values outside are far from the middle half."""
    low, high = quartiles[0.25], quartiles[0.75]
    return low - factor * (high - low), high + factor * (high - low)


def robust_outliers(df: DataFrame, id_col: str, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """``id_col``, ``column_name`` and ``value`` of values outside their
    column's bounds: one narrow scan for all columns. Unlike a mean, quartiles do
    not follow the outliers."""
    far = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).cast("double").alias("value"),
            ((F.col(c).cast("double") < F.lit(low)) | (F.col(c).cast("double") > F.lit(high))).alias("is_far"),
        )
        for c, (low, high) in bounds.items()
    ]
    return df.select(id_col, F.inline(F.array(*far))).filter("is_far").drop("is_far")


# ------------------------------------------------------------- distinct values


def distinct_sketches(df: DataFrame, columns: list[str], *keep: str, bits: int = HLL_BITS) -> DataFrame:
    """A sketch of each column's distinct values, per ``keep``; NULL is none."""
    return df.groupBy(*keep).agg(*[F.hll_sketch_agg(c, bits).alias(f"distinct_{c}") for c in columns])


def distinct_counts(sketches: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """Distinct values over all merged sketches, per ``keep``, as estimated."""
    return sketches.groupBy(*keep).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{c}")).alias(f"n_{c}") for c in columns]
    )
