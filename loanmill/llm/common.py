"""Helpers of the text operators: reading, stored stages, words and hashes.

Texts reach Python as Arrow batches. Their bytes are looked at in place, in
blocks of about a megabyte, and words are spans of offsets, so a task holds one
batch and the working arrays of one block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
#: Rows and bytes of an Arrow batch: a task holds a few batches of whole texts
#: at a time, and the JVM's buffers for one are up to twice as large.
BATCH_ROWS, BATCH_BYTES = "1000", "8m"
#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get batches of BATCH_ROWS rows from here on, and no
    more than one row beyond BATCH_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables."""
    small_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ids_and_texts(documents: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` as a long and ``text``, without a projection where there is
    none to make: scans that look alike then share one shuffle."""
    types = dict(documents.dtypes)
    number, words = F.col("doc_id"), F.col(text)
    if types["doc_id"] != "bigint":
        number = number.cast("long").alias("doc_id")
    return documents.select(number, words if text == "text" else words.alias("text"))


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, as in
    tests, below the warehouse, which every executor reaches as well."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: int) -> DataFrame:
    """Write the rows to the shared folder and read them back: a cut of the
    lineage that a lost executor does not undo. ``options`` are the writer's."""
    small_batches(df.sparkSession)
    path = work_folder(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(documents: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts: what numbers of buckets are sized by."""
    n = documents.select(F.sum(F.octet_length(column).cast("long"))).first()[0]
    return int(n or 0)


def buckets(n_bytes: int, bytes_each: int) -> int:
    """Buckets so that each holds about so many bytes of text."""
    return max(8, -(-n_bytes // bytes_each))


# ---------------------------------------------------------------- Arrow batches


def string_parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and its offsets; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    if pa.types.is_large_string(array.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = array.buffers()
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offs.astype(np.int64)


def text_blocks(
    batch: pa.RecordBatch, column: str = "text", size: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and offsets of blocks of about ``size`` bytes.

    A text is never cut; a longer one is a block by itself.
    """
    data, offs = string_parts(batch.column(column))
    at, rows = 0, batch.num_rows
    while at < rows:
        end = int(np.searchsorted(offs, offs[at] + size, "right")) - 1
        end = min(max(end, at + 1), rows)
        yield at, end, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


# ------------------------------------------------------------- words and hashes


class Powers:
    """Powers of an odd multiplier modulo 2**64, and of its inverse."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 2 * BLOCK_BYTES)
            for name, step in (("up", _STEP), ("down", _BACK)):
                factors = np.full(size, step, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self.up, self.down


POWERS = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_values(lower: bool) -> np.ndarray:
    """A 64-bit value for every byte; ``lower`` gives A-Z those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if lower:
        values[65:91] = values[97:123]
    return values


EXACT, FOLDED = byte_values(False), byte_values(True)


def word_spans(
    data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each text."""
    solid = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = edge[:-1].copy()
    before[1:] |= ~solid[:-1]
    after = edge[1:].copy()
    after[:-1] |= ~solid[1:]
    starts = np.flatnonzero(solid & before)
    ends = np.flatnonzero(solid & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value times power, by which any stretch can be hashed."""
    up, _ = POWERS.upto(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches; equal stretches have equal hashes."""
    _, down = POWERS.upto(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = FOLDED
) -> np.ndarray:
    return stretch_hashes(prefix_sums(values[data]), starts, ends)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of several stretches, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - shift, lengths)
