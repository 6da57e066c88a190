"""Rows that carry many small records to the bucket of their key.

A record is a document, a position in it and a 64-bit key. Records of one
bucket travel together as packed columns: ids of documents, records of each,
gaps between positions (two bytes, and the rare larger ones apart) and keys. That
is 6 or 10 bytes a record instead of a row of 40, and one row per chunk of text
and bucket. Buckets are sized by the bytes of all texts, so each one holds a
bounded number of records at any size of the input.

A key may stand in a third of all documents. Tasks therefore settle what they
can before they send: places whose fate is known within the chunk go straight
to their document's bucket, and one or two records of such a key go on for all
of them. A bucket then gets a few records of a key from each chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loanmill.llm.common import mix, ragged

SCHEMA = "bucket int, docs binary, sizes binary, gaps binary, far binary, keys binary"
#: Gaps from here on are kept apart.
FAR = 65535
#: Records that a task gathers before it sends them on.
CHUNK = 800_000


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets by the upper half of the key."""
    return ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def pack(
    bucket: np.ndarray, docs: np.ndarray, positions: np.ndarray, keys: np.ndarray
) -> pa.RecordBatch:
    """Records as one row per bucket. Positions ascend within a document."""
    small = 0 <= bucket.min(initial=0) and bucket.max(initial=0) < 1 << 16
    order = np.argsort(bucket.astype(np.uint16) if small else bucket, kind="stable")
    bucket, docs, positions, keys = bucket[order], docs[order], positions[order], keys[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (bucket[1:] != bucket[:-1])
    new[1:] |= positions[1:] < positions[:-1]  # a repeated row
    gaps = positions.copy()
    gaps[1:] -= np.where(new[1:], 0, positions[:-1])
    short = np.minimum(gaps, FAR).astype("<u2")
    is_far = gaps >= FAR
    firsts = np.flatnonzero(new)
    sizes = np.diff(np.append(firsts, len(docs))).astype(np.uint32)
    far = gaps[is_far].astype(np.uint32)
    far_before = np.concatenate([[0], np.cumsum(is_far)])
    edge = np.ones(len(docs) + 1, bool)
    edge[1:-1] = bucket[1:] != bucket[:-1]
    cuts = np.flatnonzero(edge) if len(docs) else np.zeros(1, np.int64)
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        i, j = np.searchsorted(firsts, [a, b])
        rows.append(
            (
                int(bucket[a]),
                docs[firsts[i:j]].tobytes(),
                sizes[i:j].tobytes(),
                short[a:b].tobytes(),
                far[far_before[a] : far_before[b]].tobytes(),
                keys[a:b].tobytes(),
            )
        )
    kinds = [pa.int32(), *[pa.binary()] * 5]
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        names=["bucket", "docs", "sizes", "gaps", "far", "keys"],
    )


def unpack(table: pa.Table, kind: str | np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, positions and keys of all records of a bucket's rows."""

    def column(name: str, dtype: str | np.dtype) -> np.ndarray:
        parts = table.column(name).to_pylist()
        return np.frombuffer(b"".join(parts), dtype)

    sizes = column("sizes", "<u4").astype(np.int64)
    docs = np.repeat(column("docs", "<i8"), sizes)
    short = column("gaps", "<u2")
    gaps = short.astype(np.int64)
    gaps[short == FAR] = column("far", "<u4")
    sums = np.cumsum(gaps)
    firsts = np.cumsum(sizes) - sizes
    positions = sums - np.repeat(sums[firsts] - gaps[firsts], sizes)
    return docs, positions, column("keys", kind)


def send(
    documents: DataFrame,
    records: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]],
    n_buckets: int,
    kind: str,
    settle: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
) -> DataFrame:
    """Rows of records; ``records`` gives documents, positions and 64-bit keys
    of blocks of a batch. ``settle`` tells, of a chunk, which records go to
    their key's bucket and which places are hits already.

    ``kind`` u4 keeps the lower half of the keys: for filters only, since
    another key of the bucket may share it. u8 keeps them all.
    """

    def packed(held: list) -> Iterator[pa.RecordBatch]:
        docs, positions, keys = map(np.concatenate, zip(*held, strict=True))
        go, known = settle(docs, positions, keys)
        yield passed(hits(docs[known], positions[known], n_buckets))
        go = np.sort(go)
        docs, positions, keys = docs[go], positions[go], keys[go]
        bucket = bucket_of(keys, n_buckets)
        if kind == "u4":
            keys = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        yield pack(bucket, docs, positions, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for block in records(batch):
                held.append(block)
                n += len(block[0])
                if n >= CHUNK:
                    yield from packed(held)
                    held, n = [], 0
        if n:
            yield from packed(held)

    return documents.mapInArrow(run, SCHEMA)


def passed(packed: pa.RecordBatch) -> pa.RecordBatch:
    """Hits under a number below zero: they only pass through the next step."""
    return packed.set_column(0, "bucket", pc.subtract(pa.scalar(-1, pa.int32()), packed.column(0)))


def meet(sent: DataFrame, resolve: Callable[[pa.Table], pa.RecordBatch]) -> DataFrame:
    """``resolve`` the records of each bucket; hits that pass through get the
    number of their document's bucket back."""

    def run(bucket: pa.Table) -> pa.Table:
        if bucket.column("bucket")[0].as_py() < 0:
            back = pc.subtract(pa.scalar(-1, pa.int32()), bucket.column("bucket"))
            return bucket.set_column(0, "bucket", back)
        return pa.Table.from_batches([resolve(bucket)])

    return sent.groupBy("bucket").applyInArrow(run, SCHEMA)


def hits(docs: np.ndarray, positions: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    """Places in documents, packed by the bucket of the document: places in a
    row are one record, whose key is their number."""
    order = np.lexsort((positions, docs))
    docs, positions = docs[order], positions[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (positions[1:] > positions[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first, len(docs))[1:] - 1
    docs, starts, counts = docs[first], positions[first], positions[last] - positions[first] + 1
    bucket = bucket_of(mix(docs.astype(np.uint64)), n_buckets)
    return pack(bucket, docs, starts, counts.astype("<u4"))


def by_document(packed: DataFrame) -> DataFrame:
    """Rows of ``hits`` as one row per document: ``doc_id`` and ``hits``, the
    starts and numbers of its places in a row, as packed 32-bit integers."""

    def run(bucket: pa.Table) -> pa.Table:
        docs, starts, counts = unpack(bucket, "<u4")
        order = np.lexsort((starts, docs))
        docs = docs[order]
        runs = np.stack([starts[order], counts[order]], 1).astype("<u4")
        firsts, _ = groups(docs, np.arange(len(docs)))
        ends = np.append(firsts, len(docs))[1:]
        blobs = [runs[a:b].tobytes() for a, b in zip(firsts, ends, strict=True)]
        return pa.table({"doc_id": pa.array(docs[firsts]), "hits": pa.array(blobs, pa.binary())})

    return packed.groupBy("bucket").applyInArrow(run, "doc_id long, hits binary")


def runs(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and numbers of the places in a row of a document that was joined
    with ``by_document``; none if NULL. Runs are in order and may overlap."""
    blob = batch.column("hits")[row].as_py() or b""
    starts, counts = np.frombuffer(blob, "<u4").reshape(-1, 2).T.astype(np.int64)
    return starts, counts


def places(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """The places of ``runs``, each once."""
    starts, counts = runs(batch, row)
    return np.unique(ragged(starts, counts))


def any_of(mask: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Whether any place of each group has the mask."""
    return np.add.reduceat(mask.astype(np.int64), firsts) > 0 if len(mask) else mask


def groups(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For keys in sorted order: first places of the groups, and each place's group."""
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1
