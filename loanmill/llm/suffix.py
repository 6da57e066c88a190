"""Repeated byte strings between documents, by suffix arrays of shards.

1. Which stretches can repeat at all. Of each string of ``length`` bytes the
   ``GRAM``-byte piece with the smallest hash is its anchor, so equal strings
   have equal anchors. Anchors meet in buckets of their hash; strings whose
   anchor stands in one document only cannot repeat and go no further.
2. The strings that are left form the shards, a bounded number of bytes each by
   document. A shard's suffixes are sorted by the refinement of Larsson and
   Sadakane: by 8 bytes, then groups that are still open by the ranks of what
   follows, to 16, 32 and ``length`` bytes. Common prefixes of neighbours follow
   Kasai, in lanes: along the text they shrink by at most one a step. Suffixes
   that share ``length`` bytes are one class.
3. Shards are merged at the anchors. Strings in a row that share an anchor are
   one piece, and a shard sends one record of each piece that holds the shard's
   first string of a class. In a bucket of anchors the records are grouped by
   the pieces' hashes, which tells each the smallest document with the same
   piece: all strings of a later one repeat.
4. Where an anchor has several pieces, or many in one shard, their strings may
   still be equal in part. The strings of the first document of each such piece
   meet once more, each by its own hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.llm import exchange
from loanmill.llm.common import (
    EXACT,
    buckets,
    ids_and_texts,
    mix,
    prefix_sums,
    ragged,
    stretch_hashes,
    string_parts,
    text_blocks,
    text_bytes,
)

GRAM = 24
BUCKET_BYTES, SHARD_BYTES = 16 << 20, 4 << 20
#: Bytes of text whose anchors are found at once.
BLOCK = 256 << 10
LANE = 512
#: Pieces of one anchor that a shard sends to be merged; of more, none.
MANY_PIECES = 8
PIECE = np.dtype([("anchor", "<u8"), ("piece", "<u8"), ("strings", "u1")])


def anchors(
    data: np.ndarray, offs: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all strings of ``length`` bytes within texts, the anchor of
    each string, and the hash of the piece at each place of the data."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(data) - GRAM + 1)
    hashes = stretch_hashes(prefix_sums(EXACT[data]), at, at + GRAM)
    low = (hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, span = length - GRAM + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    inside = np.zeros(n + 1, np.int64)
    counts = np.diff(offs) - length + 1
    some = counts > 0
    np.add.at(inside, offs[:-1][some], 1)
    np.add.at(inside, offs[:-1][some] + counts[some], -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    return starts, (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64), hashes


def _shared(docs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of anchors: an order by hash, the first of each group, each place's
    group, and whether a group stands in two documents or more."""
    order = np.lexsort((docs, keys))
    firsts, group = exchange.groups(keys, order)
    lasts = np.append(firsts, len(keys))[1:] - 1
    return order, firsts, group, docs[order[firsts]] < docs[order[lasts]]


def _settle_anchors(
    docs: np.ndarray, positions: np.ndarray, keys: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Anchors in one document go on, two documents of each other anchor too."""
    order, firsts, group, good = _shared(docs, keys)
    lasts = np.append(firsts, len(keys))[1:] - 1
    known = good[group]
    return order[np.concatenate([np.flatnonzero(~known), firsts[good], lasts[good]])], order[known]


def _settle_strings(
    docs: np.ndarray, positions: np.ndarray, keys: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Strings of the smallest document of their hash, and those of later ones."""
    order = np.lexsort((docs, keys))
    firsts, group = exchange.groups(keys, order)
    later = docs[order] > docs[order[firsts[group]]]
    return order[~later], order[later]


# ------------------------------------------------------------------- one shard


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The next eight bytes at each place as one big-endian number."""
    key, span = data.astype(np.uint64), 1
    while span < 8:
        later = np.zeros_like(key)
        later[:-span] = key[span:]
        key = (key << np.uint64(8 * span)) | later
        span *= 2
    return key


def suffix_ranks(key: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Rank of the string of ``length`` bytes at each place, -1 where its
    region ends before; equal strings have equal ranks.

    ``key`` are the eight bytes of each place, ``left`` the bytes up to the end
    of its region.
    """
    n = len(key)
    at = np.flatnonzero(left >= 8)
    order = at[np.argsort(key[at], kind="stable")]
    ordered = key[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    firsts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    rank = np.full(n, -1, np.int64)
    rank[order] = firsts[group]
    depth = 8
    while depth < length:
        deeper = min(2 * depth, length)
        open_ = np.diff(np.append(firsts, len(order)))[group] > 1
        order = order[open_]
        order = order[left[order] >= deeper]
        pair = rank[order] * np.int64(n + 1) + rank[order + deeper - depth]
        by = np.argsort(pair, kind="stable")
        order, pair = order[by], pair[by]
        new = np.ones(len(order), bool)
        new[1:] = pair[1:] != pair[:-1]
        firsts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        # A group keeps its slots; its parts start where they lie within it.
        old = rank[order]
        begin = np.ones(len(order), bool)
        begin[1:] = old[1:] != old[:-1]
        begins = np.flatnonzero(begin)
        place = firsts[group] - begins[np.cumsum(begin) - 1]
        rank[order] = old + place
        depth = deeper
    rank[left < length] = -1
    return rank


def common_prefixes(
    data: np.ndarray, key: np.ndarray, before: np.ndarray, place: np.ndarray, length: int
) -> np.ndarray:
    """Bytes, up to ``length``, that each suffix shares with the one before it
    in order (``before``; -1: none). ``place`` is a suffix's place in the order,
    -1 for what is none, with one more at the end.

    Lanes of places run side by side, each in text order. Where the suffix after
    the last one's neighbour also stands before this one, the prefix is at most
    one shorter than the last; at the ends of regions, and among strings that
    are equal as far as they are sorted, it may not, and counting starts anew.
    """
    n = len(before)
    out = np.zeros(n, np.int64)
    lanes = np.arange(0, n, LANE)
    h, last = np.zeros(len(lanes), np.int64), np.full(len(lanes), -1, np.int64)
    for step in range(min(LANE, n)):
        p = lanes + step
        if p[-1] >= n:
            p, lanes, h, last = p[:-1], lanes[:-1], h[:-1], last[:-1]
        q = before[p]
        ahead = np.where(last >= 0, place[last + 1], -1)
        carry = (q >= 0) & (ahead >= 0) & (ahead < place[p])
        h = np.where(carry, np.maximum(h - 1, 0), 0)
        last = q
        go = np.flatnonzero((q >= 0) & (h + 8 <= length))
        while len(go):
            go = go[key[p[go] + h[go]] == key[q[go] + h[go]]]
            h[go] += 8
            go = go[h[go] + 8 <= length]
        go = np.flatnonzero((q >= 0) & (h < length))
        while len(go):
            go = go[data[p[go] + h[go]] == data[q[go] + h[go]]]
            h[go] += 1
            go = go[h[go] < length]
        out[p] = h
    return out


def shard_classes(
    data: np.ndarray, bounds: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of all strings of ``length`` bytes within regions, and
    the first place in it of each class of equal strings."""
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(data))
    key = eight_bytes(data)
    rank = suffix_ranks(key, left, length)
    places = np.flatnonzero(rank >= 0)
    suffixes = places[np.argsort(rank[places], kind="stable")]
    before = np.full(len(data), -1, np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    place = np.full(len(data) + 1, -1, np.int64)
    place[suffixes] = np.arange(len(suffixes))
    prefixes = common_prefixes(data, key, before, place, length)
    return suffixes, np.flatnonzero(prefixes[suffixes] < length)


def _of_shard(shard: pa.Table, length: int, n_buckets: int, many_pieces: int) -> pa.Table:
    """Records of the shard's classes, and repeats that it knows by itself."""
    ids = shard.column("doc_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    shard = shard.take(pa.array(order))
    ids = ids[order]

    def column(name: str, dtype: str) -> list[np.ndarray]:
        return [np.frombuffer(x, dtype) for x in shard.column(name).to_pylist()]

    starts, sizes = column("starts", "<u4"), column("sizes", "<u4")
    data = np.concatenate(column("pieces", "u1"))
    regions = np.fromiter(map(len, starts), np.int64, len(starts))
    starts, sizes = np.concatenate(starts).astype(np.int64), np.concatenate(sizes).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.repeat(ids, regions), sizes)
    position = ragged(starts, sizes)
    suffixes, firsts = shard_classes(data, bounds, length)
    owner = doc[suffixes]
    smallest = np.minimum.reduceat(owner, firsts)
    sizes_of = np.diff(np.append(firsts, len(suffixes)))
    mine = owner == np.repeat(smallest, sizes_of)
    known = exchange.hits(doc[suffixes[~mine]], position[suffixes[~mine]], n_buckets)

    # Pieces: strings in a row with one anchor, of which any is the first.
    is_mine = np.zeros(len(data), np.int64)
    is_mine[suffixes[mine]] = 1
    string, anchor, hashes = anchors(data, bounds, length)
    new = np.ones(len(string), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(string) > 1)
    first = np.flatnonzero(new)
    last = np.append(first, len(string))[1:] - 1
    use = np.add.reduceat(is_mine[string], first) > 0
    first, last = first[use], last[use]
    begin, end = string[first], string[last]
    keys = np.zeros(len(first), PIECE)
    keys["anchor"] = mix(hashes[anchor[first]])
    keys["piece"] = stretch_hashes(prefix_sums(EXACT[data]), begin, end + length)
    keys["piece"] ^= mix((anchor[first] - begin).astype(np.uint64))
    keys["strings"] = end - begin + 1

    # Of an anchor with many pieces in one shard all strings are in doubt. One
    # record without strings goes on and puts those of other shards in doubt,
    # also where the many are one and the same piece of a document.
    order = np.argsort(keys["anchor"], kind="stable")
    firsts, group = exchange.groups(keys["anchor"], order)
    many = np.diff(np.append(firsts, len(order)))[group] > many_pieces
    leads = np.arange(len(order)) == firsts[group]
    doubtful, go = order[many], np.sort(order[~many | leads])
    sent = keys.copy()
    sent["strings"][doubtful] = sent["piece"][doubtful] = 0
    records = exchange.pack(
        exchange.bucket_of(keys["anchor"][go], n_buckets), doc[begin[go]], position[begin[go]], sent[go]
    )
    places = ragged(begin[doubtful], keys["strings"][doubtful].astype(np.int64))
    doubt = exchange.hits(doc[places], position[places], n_buckets)
    doubt = doubt.set_column(0, "bucket", pc.add(doubt.column(0), pa.scalar(n_buckets, pa.int32())))
    return pa.Table.from_batches([records, exchange.passed(known), exchange.passed(doubt)])


def _merge(bucket: pa.Table, n_buckets: int) -> pa.RecordBatch:
    """Strings of pieces that stand in a smaller document; and, numbered beyond
    the buckets, strings in doubt."""
    docs, positions, keys = exchange.unpack(bucket, PIECE)
    order = np.lexsort((docs, keys["piece"], keys["anchor"]))
    docs, positions, keys = docs[order], positions[order], keys[order]
    pair = keys[["anchor", "piece"]]
    new = np.ones(len(keys), bool)
    new[1:] = pair[1:] != pair[:-1]
    merged = np.flatnonzero(new)
    # The place of each record's piece in the merged list.
    found = np.searchsorted(merged, np.arange(len(keys)), "right") - 1
    later = docs > docs[merged[found]]
    firsts, group = exchange.groups(keys["anchor"], np.arange(len(keys)))
    strings = keys["strings"].astype(np.int64)
    several = np.add.reduceat(new.astype(np.int64), firsts) > 1
    several |= np.minimum.reduceat(strings, firsts) == 0
    in_doubt = several[group] & ~later
    out = []
    for which, shift in ((later, 0), (in_doubt, n_buckets)):
        own = np.repeat(docs[which], strings[which])
        part = exchange.hits(own, ragged(positions[which], strings[which]), n_buckets)
        number = pc.add(part.column(0), pa.scalar(shift, pa.int32()))
        out.append(part.set_column(0, "bucket", number))
    return pa.Table.from_batches(out).combine_chunks().to_batches()[0]


# ------------------------------------------------------------------ the operator


def candidates(documents: DataFrame, length: int, n_bytes: int) -> DataFrame:
    """Per document with shared anchors: packed ``starts`` and ``sizes`` of the
    regions that their strings cover, and the regions' bytes as ``pieces``."""

    def probes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for lo, _, data, offs in text_blocks(batch, size=BLOCK):
            _, anchor, hashes = anchors(data, offs, length)
            places = np.unique(anchor)
            text = np.searchsorted(offs, places, "right") - 1
            # Anchors are smallest hashes; mixed again they spread over all buckets.
            yield ids[lo + text], places - offs[text], mix(hashes[places])

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[bytes]] = [[b""] * batch.num_rows for _ in range(3)]
            for lo, hi, data, offs in text_blocks(batch, size=BLOCK):
                starts, anchor, _ = anchors(data, offs, length)
                hit = np.zeros(len(data) + 1, bool)
                for row in range(lo, hi):
                    hit[offs[row - lo] + exchange.places(batch, row)] = True
                starts = starts[hit[anchor]]
                text = np.searchsorted(offs, starts, "right") - 1
                new = np.ones(len(starts), bool)
                new[1:] = (np.diff(starts) > 1) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(starts)) - 1
                begin, end = starts[first], starts[last] + length
                of_text = np.searchsorted(text[first], np.arange(hi - lo + 1))
                raw = data.tobytes()
                for row in range(lo, hi):
                    a, b = of_text[row - lo], of_text[row - lo + 1]
                    out[0][row] = (begin[a:b] - offs[row - lo]).astype("<u4").tobytes()
                    out[1][row] = (end[a:b] - begin[a:b]).astype("<u4").tobytes()
                    out[2][row] = b"".join(
                        raw[x:y] for x, y in zip(begin[a:b].tolist(), end[a:b].tolist(), strict=True)
                    )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.binary()) for x in out]],
                names=["doc_id", "starts", "sizes", "pieces"],
            )

    n_buckets = buckets(n_bytes, BUCKET_BYTES)

    def resolve(bucket: pa.Table) -> pa.RecordBatch:
        docs, positions, keys = exchange.unpack(bucket, "<u4")
        order, _, group, good = _shared(docs, keys)
        take = order[good[group]]
        return exchange.hits(docs[take], positions[take], n_buckets)

    hits = exchange.meet(exchange.send(documents, probes, n_buckets, "u4", _settle_anchors), resolve)
    return (
        documents.join(exchange.by_document(hits), "doc_id")
        .mapInArrow(regions, "doc_id long, starts binary, sizes binary, pieces binary")
        .filter(F.length("starts") > 0)
    )


def repeated_strings(documents: DataFrame, length: int) -> DataFrame:
    """Per document with repeats: ``hits``, packed starts, in bytes, of the
    strings that also start in a document with a smaller id."""
    if length <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    n_bytes = text_bytes(documents)
    n_shards, n_buckets = buckets(n_bytes, SHARD_BYTES), buckets(n_bytes, BUCKET_BYTES)
    shards = candidates(documents, length, n_bytes).withColumn(
        "shard", F.pmod(F.xxhash64("doc_id"), F.lit(n_shards)).cast("int")
    )
    sent = shards.groupBy("shard").applyInArrow(
        lambda shard: _of_shard(shard, length, n_buckets, MANY_PIECES), exchange.SCHEMA
    )
    merged = exchange.meet(sent, lambda bucket: _merge(bucket, n_buckets))
    settled = merged.filter(F.col("bucket") < n_buckets)
    in_doubt = merged.filter(F.col("bucket") >= n_buckets)

    def strings(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for lo, hi, data, offs in text_blocks(batch, size=BLOCK):
            places = [exchange.places(batch, row) for row in range(lo, hi)]
            text = np.repeat(np.arange(hi - lo), [len(x) for x in places])
            position = np.concatenate(places)
            at = offs[text] + position
            sums = prefix_sums(EXACT[data])
            yield ids[lo + text], position, stretch_hashes(sums, at, at + length)

    def resolve(bucket: pa.Table) -> pa.RecordBatch:
        docs, positions, keys = exchange.unpack(bucket, "<u8")
        _, later = _settle_strings(docs, positions, keys)
        return exchange.hits(docs[later], positions[later], n_buckets)

    asked = documents.join(exchange.by_document(in_doubt), "doc_id")
    again = exchange.send(asked, strings, n_buckets, "u8", _settle_strings)
    return exchange.by_document(settled.unionByName(exchange.meet(again, resolve)))


def remove_repeats(documents: DataFrame, length: int = 50, text: str = "text") -> DataFrame:
    """Remove every byte of a string of ``length`` bytes that also starts in a
    document with a smaller doc_id.

    Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept``, the bytes that stay; a cut may split a character.
    Strings are judged on the input and overlap freely. A NULL text has no
    bytes. Rows that share an id are never compared with each other; a row
    without an id takes no part and keeps all its bytes.
    """
    named = ids_and_texts(documents, text)
    nameless = named.filter("doc_id is null")
    named = named.filter("doc_id is not null")
    repeats = repeated_strings(named, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = string_parts(batch.column("text"))
            counts: list[list[int]] = [[], [], []]
            kept = []
            for row in range(batch.num_rows):
                raw = data[offs[row] : offs[row + 1]]
                starts, counts_in_row = exchange.runs(batch, row)
                spans = gone = 0
                left = raw.tobytes()
                if len(starts):
                    ends = np.maximum.accumulate(starts + counts_in_row - 1 + length)
                    apart = np.flatnonzero(starts[1:] > ends[:-1])
                    begin = starts[np.append(0, apart + 1)]
                    end = ends[np.append(apart, len(starts) - 1)]
                    spans, gone = len(begin), int((end - begin).sum())
                    cuts = zip(np.append(0, end), np.append(begin, len(raw)), strict=True)
                    left = b"".join(left[a:b] for a, b in cuts)
                for out, n in zip(counts, (len(raw), gone, spans), strict=True):
                    out.append(n)
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(x, pa.int64()) for x in counts],
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    rows = named.join(repeats, "doc_id", "left").unionByName(nameless, allowMissingColumns=True)
    return rows.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def digests(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
