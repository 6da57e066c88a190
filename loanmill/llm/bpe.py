"""Byte-level BPE over a public rank file, as a pair of table operators.

Texts are cut by the vocabulary's pattern. Distinct pieces are put into numpy
matrices by length; in each round every row merges its leftmost pair of the
least rank, so all rows of a matrix lose one column together, and rows without
a pair left are taken out. Ranks of pairs come from an open-addressing table.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from loanmill.llm.common import ragged, text_blocks

#: Pieces that are looked up at once, and pieces that a task remembers.
PIECES, REMEMBERED = 100_000, 250_000
#: Bytes of the widest matrix; longer pieces merge through a heap.
WIDEST = 1024
NEVER = np.int32(2**31 - 1)
#: Rows that are decoded at once.
ROWS = 500


def read_ranks(path: str) -> bytes:
    """The rank file's bytes; a vocabulary, so a few megabytes at most."""
    with open(path, "rb") as file:
        return file.read()


class PairTable:
    """Ranks of pairs of ids, by hashed lookups with linear probing."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NEVER, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[todo[free]]
            mine = self.keys[at] == keys[todo]
            self.ranks[at[mine]] = ranks[todo[mine]]
            todo, at = todo[~mine], (at[~mine] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NEVER where there is none or an id is negative."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys = np.where((left < 0) | (right < 0), np.int64(-2), keys)
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.ranks[at], NEVER)
        open_ = np.flatnonzero((found != keys) & (found != -1) & (keys != -2))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


def parse_ranks(rank_file: bytes) -> dict[bytes, int]:
    fields = (line.split() for line in rank_file.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in fields}


class Vocabulary:
    """Ids by bytes, and the ranks of all pairs that merge."""

    def __init__(self, rank_file: bytes) -> None:
        self.ids = parse_ranks(rank_file)
        keys, ranks = [], []
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank)
        self.pairs = PairTable(np.array(keys, np.int64), np.array(ranks, np.int32))
        self.rank_of = dict(zip(keys, ranks, strict=True))
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        known = np.fromiter(map(self.ids.get, pieces, repeat(-1)), np.int64, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        whole = np.flatnonzero(known >= 0)
        parts = [(whole, known[whole, None], np.ones(len(whole), np.int64))]
        open_ = np.flatnonzero((known < 0) & (sizes > 0))
        widths = np.maximum(4, 1 << np.ceil(np.log2(np.maximum(sizes[open_], 1))).astype(np.int64))
        for width in np.unique(widths):
            rows = open_[widths == width]
            step = max(1, (1 << 21) // int(width)) if width <= WIDEST else 1
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                if width <= WIDEST:
                    parts += self._by_matrix([pieces[i] for i in some], some, int(width))
                else:
                    ids = self._by_heap(pieces[some[0]])
                    parts.append((some, ids[None, :], np.array([len(ids)])))
        lengths = np.zeros(len(pieces), np.int64)
        for who, _, n in parts:
            lengths[who] = n
        starts = np.cumsum(lengths) - lengths
        flat = np.zeros(int(lengths.sum()), np.int32)
        for who, ids, n in parts:
            flat[ragged(starts[who], n)] = ids[np.arange(ids.shape[1]) < n[:, None]]
        return flat, lengths

    def _by_matrix(
        self, pieces: list[bytes], who: np.ndarray, width: int
    ) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Finished rows: their numbers, padded ids and lengths."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = b"".join([piece.ljust(width, b"\0") for piece in pieces])
        ids = self.single[np.frombuffer(raw, np.uint8).reshape(-1, width)]
        ids[np.arange(width) >= lengths[:, None]] = -1
        ranks = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel())
        ranks = ranks.reshape(-1, width - 1)
        out = []
        while len(who):
            n = ids.shape[1]
            at = ranks.argmin(1) if n > 1 else np.zeros(len(who), np.int64)
            best = ranks[np.arange(len(who)), at] if n > 1 else np.full(len(who), NEVER)
            done = best == NEVER
            if done.any():
                out.append((who[done], ids[done], lengths[done]))
                go = ~done
                who, ids, ranks, lengths = who[go], ids[go], ranks[go], lengths[go]
                at, best = at[go], best[go]
                if not len(who):
                    break
            line = np.arange(len(who))
            ids[line, at] = best
            keep = np.ones(ids.shape, bool)
            keep[line, at + 1] = False
            ids = ids[keep].reshape(len(who), n - 1)
            keep = np.ones(ranks.shape, bool)
            keep[line, at] = False
            ranks = ranks[keep].reshape(len(who), n - 2)
            lengths = lengths - 1
            for col in (at - 1, at):
                some = np.flatnonzero((col >= 0) & (col < n - 2))
                c = col[some]
                ranks[some, c] = self.pairs.get(ids[some, c], ids[some, c + 1])
        return out

    def _by_heap(self, piece: bytes) -> np.ndarray:
        """The same merges for one very long piece, in n log n steps."""
        ids: list[int] = [int(self.single[b]) for b in piece]
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        rank_of, heap = self.rank_of, []
        for i in range(len(ids) - 1):
            rank = rank_of.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                heap.append((rank, i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0:
                    new = rank_of.get(ids[a] << 32 | ids[b])
                    if new is not None:
                        heapq.heappush(heap, (new, a, ids[a], ids[b]))
        return np.array([x for x in ids if x >= 0], np.int32)


class _Memory(dict):
    """Numbers pieces as they come up; ``new`` are those not yet encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class Encoder:
    """Encodes texts one after the other and remembers pieces."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        self.vocabulary = Vocabulary(rank_file)
        self.pattern = regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.memory = _Memory()
        self.flat = np.zeros(0, np.int32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def _ids(self, pieces: list[str]) -> np.ndarray:
        if len(self.memory) > REMEMBERED:
            self._forget()
        numbers = np.fromiter(map(self.memory.__getitem__, pieces), np.int64, len(pieces))
        if self.memory.new:
            added, lengths = self.vocabulary.encode_pieces([p.encode() for p in self.memory.new])
            starts = np.cumsum(lengths) - lengths + len(self.flat)
            self.flat = np.concatenate([self.flat, added])
            self.starts = np.concatenate([self.starts, starts])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.memory.new = []
        lengths = self.lengths[numbers]
        self.ends = np.cumsum(lengths)
        return self.flat[ragged(self.starts[numbers], lengths)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text, in groups of PIECES pieces at a time."""
        out, held, bounds = [], [], []

        def flush() -> None:
            ids = self._ids(held).astype("<u4")
            ends = np.concatenate([[0], self.ends])
            low = 0
            for high in bounds:
                out.append(ids[ends[low] : ends[high]].tobytes())
                low = high
            held.clear()
            bounds.clear()

        for text in texts:
            if len(text) <= 4 * PIECES:
                held.extend(self.pattern.findall(text))
                bounds.append(len(held))
                if len(held) >= PIECES:
                    flush()
                continue
            flush()
            found, parts = self.pattern.finditer(text), []
            while some := [m[0] for m in islice(found, PIECES)]:
                parts.append(self._ids(some).astype("<u4").tobytes())
            out.append(b"".join(parts))
        flush()
        return out


def encode(
    documents: DataFrame, rank_file: bytes, pattern: str, text: str = "text", out: str = "ids"
) -> DataFrame:
    """Add ``out``, the ids of the whole text as little-endian 32-bit integers,
    and ``n_tokens``.

    A NULL or empty text has no ids. Input columns named like the outputs are
    replaced; all others stay as they are. Repeated rows are encoded each.
    """
    keep = [c for c in documents.columns if c not in (out, "n_tokens")]
    schema = documents.select(*keep).schema.add(out, "binary").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(rank_file, pattern)
        for batch in batches:
            for lo, hi, _, _ in text_blocks(batch, text):
                part = batch.slice(lo, hi - lo)
                packed = encoder.encode_all(part.column(text).fill_null("").to_pylist())
                sizes = [len(x) // 4 for x in packed]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())],
                    names=[*batch.schema.names, out, "n_tokens"],
                )

    return documents.select(*keep).mapInArrow(run, schema)


def decode(
    encoded: DataFrame, rank_file: bytes, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """Add ``out``, the bytes that packed ids stand for.

    NULL or no ids give no bytes. An id that the vocabulary lacks is an error.
    """
    keep = [c for c in encoded.columns if c != out]
    schema = encoded.select(*keep).schema.add(out, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in parse_ranks(rank_file).items()}
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                texts = [
                    b"".join(map(tokens.__getitem__, np.frombuffer(x or b"", "<u4").tolist()))
                    for x in part.column(ids).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary())],
                    names=[*batch.schema.names, out],
                )

    return encoded.select(*keep).mapInArrow(run, schema)


def round_trip(
    documents: DataFrame, rank_file: bytes, pattern: str, text: str = "text", out: str = "ids"
) -> DataFrame:
    """Replace the text by ``out``, its packed ids, ``n_tokens`` and
    ``round_trip``: whether the ids decode to the text (NULL: to none).

    One worker a task encodes and decodes, block by block, and the text goes no
    further. Input columns named like the outputs are replaced.
    """
    made = (out, "n_tokens", "round_trip")
    keep = [c for c in documents.columns if c not in (text, *made)]
    schema = documents.select(*keep).schema.add(out, "binary").add("n_tokens", "long").add("round_trip", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(rank_file, pattern)
        ids = encoder.vocabulary.ids
        tokens = dict(zip(ids.values(), ids.keys(), strict=True)).__getitem__
        for batch in batches:
            for lo, hi, _, _ in text_blocks(batch, text):
                part = batch.slice(lo, hi - lo)
                texts = part.column(text).fill_null("").to_pylist()
                packed = encoder.encode_all(texts)
                same = [
                    b"".join(map(tokens, np.frombuffer(x, "<u4").tolist())) == t.encode()
                    for x, t in zip(packed, texts, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in keep],
                        pa.array(packed, pa.binary()),
                        pa.array([len(x) // 4 for x in packed], pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=[*keep, out, "n_tokens", "round_trip"],
                )

    return documents.select(*keep, text).mapInArrow(run, schema)


def unpacked(encoded: DataFrame, ids: str = "ids", out: str = "token_ids") -> DataFrame:
    """Add packed ids as an array of integers, for small results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(x or b"", "<u4").tolist() for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.list_(pa.int32()))],
                names=[*batch.schema.names, out],
            )

    schema = encoded.select("*").schema.add(out, ArrayType(IntegerType()))
    return encoded.mapInArrow(run, schema)


def digests(documents: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """Per document: ids encoded and decoded again, as digests."""
    encoded = encode(documents.select("doc_id", "text"), rank_file, pattern).drop("text")
    return decode(encoded, rank_file).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
