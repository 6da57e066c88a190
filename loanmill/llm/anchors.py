"""Repeated word passages, by anchors at fixed blocks.

Every document is cut into reference blocks of ``block`` words that do not
overlap. A window of ``window >= 2 * block - 1`` words holds a whole block
wherever it starts, so two equal windows share a block of one of them, which a
rolling probe of the other finds. Three steps:

1. All rolling probes meet the blocks in buckets of their hash. A probe hits if
   its hash is that of a block and occurs at least twice. Only 4 bytes of the
   hash travel beside the bucket: a false hit costs work and changes nothing.
2. Windows around hits are extended to exact repeats: windows that hold a hit
   meet in buckets of their 64-bit hash, and all but the first by document and
   start are repeats. A passage that thousands of documents share is thousands
   of records and never pairs of them.
3. Repeats go back to their documents, where overlapping ones run together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.llm import exchange
from loanmill.llm.common import (
    EXACT,
    buckets,
    ids_and_texts,
    prefix_sums,
    stretch_hashes,
    string_parts,
    text_blocks,
    text_bytes,
    word_hashes,
    word_spans,
)

BUCKET_BYTES = 24 << 20


def rolling(
    data: np.ndarray, offs: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, starts in words and hashes of all windows of ``width`` words."""
    begins, ends, bounds = word_spans(data, offs)
    sums = prefix_sums(word_hashes(data, begins, ends, EXACT))
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    which = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = bounds[which] + starts
    return which, starts, stretch_hashes(sums, at, at + width)


def _probe_hits(positions: np.ndarray, keys: np.ndarray, block: int) -> tuple[np.ndarray, ...]:
    """Of probes: an order by hash, the groups in it, and whether each group is
    a hit: two or more, a block's among them."""
    order = np.argsort(keys, kind="stable")
    firsts, group = exchange.groups(keys, order)
    sizes = np.diff(np.append(firsts, len(keys)))
    return order, firsts, group, (sizes > 1) & exchange.any_of(positions[order] % block == 0, firsts)


def _window_repeats(
    docs: np.ndarray, positions: np.ndarray, keys: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The first window of each hash by document and start, and the later ones."""
    order = np.lexsort((positions, docs, keys))
    firsts, group = exchange.groups(keys, order)
    first = order[firsts[group]]
    later = (docs[order] != docs[first]) | (positions[order] != positions[first])
    return order[firsts], order[later]


def repeated_windows(documents: DataFrame, window: int, block: int) -> DataFrame:
    """Per document with repeats: ``hits``, packed starts, in words, of the
    windows that also start earlier. Documents have ids."""
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block wherever it starts")
    n_buckets = buckets(text_bytes(documents), BUCKET_BYTES)

    def probes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for lo, _, data, offs in text_blocks(batch):
            which, starts, keys = rolling(data, offs, block)
            yield ids[lo + which], starts, keys

    def near_hits(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for lo, _, data, offs in text_blocks(batch):
            which, starts, keys = rolling(data, offs, window)
            counts = np.bincount(which, minlength=len(offs) - 1)
            first = np.cumsum(counts) - counts
            change = np.zeros(len(which) + 1, np.int64)
            for text, n in enumerate(counts):
                if n:
                    at = exchange.places(batch, lo + text)
                    # A block at word j lies in the windows that start from
                    # j - (window - block) to j.
                    np.add.at(change, first[text] + np.clip(at - (window - block), 0, n), 1)
                    np.add.at(change, first[text] + np.clip(at + 1, 0, n), -1)
            near = np.flatnonzero(np.cumsum(change[:-1]) > 0)
            yield ids[lo + which[near]], starts[near], keys[near]

    def settle_probes(
        docs: np.ndarray, positions: np.ndarray, keys: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        order, firsts, group, good = _probe_hits(positions, keys, block)
        known = good[group]
        # One block stands for all probes of a hash that are hits already.
        stand = known & (positions[order] % block == 0)
        at = np.flatnonzero(stand)
        at = at[np.unique(group[at], return_index=True)[1]]
        return order[np.append(np.flatnonzero(~known), at)], order[known]

    def resolve_probes(bucket: pa.Table) -> pa.RecordBatch:
        docs, positions, keys = exchange.unpack(bucket, "<u4")
        order, _, group, good = _probe_hits(positions, keys, block)
        take = order[good[group]]
        return exchange.hits(docs[take], positions[take], n_buckets)

    def resolve_windows(bucket: pa.Table) -> pa.RecordBatch:
        docs, positions, keys = exchange.unpack(bucket, "<u8")
        _, later = _window_repeats(docs, positions, keys)
        return exchange.hits(docs[later], positions[later], n_buckets)

    probing = exchange.send(documents, probes, n_buckets, "u4", settle_probes)
    hits = exchange.by_document(exchange.meet(probing, resolve_probes))
    candidates = documents.join(hits, "doc_id")
    extending = exchange.send(candidates, near_hits, n_buckets, "u8", _window_repeats)
    return exchange.by_document(exchange.meet(extending, resolve_windows))


def remove_repeats(
    documents: DataFrame, window: int = 20, block: int = 10, text: str = "text"
) -> DataFrame:
    """Remove every word of a window of ``window`` words that also starts
    earlier: in a smaller doc_id, or before it in the same document.

    Returns ``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words that
    stay, joined by one space. Windows are judged on the input. A NULL text has
    no words. Rows that share an id and a text are one document and come out
    the same; a row without an id takes no part and keeps all its words.
    """
    named = ids_and_texts(documents, text)
    nameless = named.filter("doc_id is null")
    named = named.filter("doc_id is not null")
    repeats = repeated_windows(named, window, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = string_parts(batch.column("text"))
            data = data.tobytes()
            n_words, n_removed, kept = [], [], []
            for row in range(batch.num_rows):
                words = data[offs[row] : offs[row + 1]].split()
                starts, counts = exchange.runs(batch, row)
                gone = 0
                if len(starts):
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + counts - 1 + window, -1)
                    stays = np.cumsum(change[:-1]) == 0
                    gone = len(words) - int(stays.sum())
                    left = b" ".join(compress(words, stays.tolist()))
                else:
                    left = b" ".join(words)
                n_words.append(len(words))
                n_removed.append(gone)
                kept.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    rows = named.join(repeats, "doc_id", "left").unionByName(
        nameless, allowMissingColumns=True
    )
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def digests(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
