"""Vectors as four bytes: product codes by Lloyd rounds over active entries.

Components become whole numbers, vectors are cut into equal parts, and each part
position has a codebook of 256 entries. A round assigns every part to its nearest
entry and moves each entry to the floor of the mean of its parts.

Rows carry their parts' entries and exact squared distances from round to round.
Where a part's own entry stayed fixed, all fixed entries are as far as they were
and none of them can be nearer, so the part meets only the entries that moved;
parts whose entry moved are compared with all. Equal distances go to the lower
entry either way, and all arithmetic is exact.

The driver holds the codebooks: 256 entries for each length of vectors. What it
collects a round is one sum for each of their components, added up in the tasks
before they are shuffled. Rows are written to the shared folder after each round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.llm.common import staged

#: Lengths that vectors of one table may have; each has its own codebooks.
MOST_LENGTHS = 16
#: Doubles hold whole numbers up to here exactly, longs up to WIDEST.
EXACT, WIDEST = 2**53, 2**62
STATE = "vec_id long, label string, v array<bigint>, codes binary, dists array<bigint>"


def integers(vectors: DataFrame, scale: int = 1024, label: str = "label") -> DataFrame:
    """``vec_id``, ``label`` as text and ``v``: floor(scale * component).

    Rows whose vector is NULL or holds a NULL, NaN or infinite component are
    dropped; rows without an id or a label stay, and so do repeated rows.
    """
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.filter("embedding is not null").filter(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        whole.alias("v"),
    )


def cuts(length: int, parts: int) -> list[int]:
    """Where the parts of a vector begin; they are equal if ``parts`` divides
    the length, else they differ by one component."""
    return [i * length // parts for i in range(parts + 1)]


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of points (rows) and entries (columns)."""
    largest = int(max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)))
    bound = 4 * max(points.shape[1], 1) * largest**2
    if bound >= WIDEST:
        raise OverflowError("components are too large: squared distances do not fit 64 bits")
    kind = np.float64 if bound < EXACT else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    square = (p * p).sum(1)[:, None] + (e * e).sum(1)[None] - 2 * (p @ e.T)
    return square.astype(np.int64)


def full_scan(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point, the lowest of equals, and its distance."""
    far = distances(points, entries)
    code = far.argmin(1)
    return code, far[np.arange(len(far)), code]


def active_scan(
    points: np.ndarray,
    entries: np.ndarray,
    moved: np.ndarray,
    code: np.ndarray,
    dist: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """The same as ``full_scan``, from the entry and distance of the round
    before and which entries have moved since."""
    code, dist = code.copy(), dist.copy()
    lost = moved[code]
    if lost.any():
        code[lost], dist[lost] = full_scan(points[lost], entries)
    kept = np.flatnonzero(~lost)
    active = np.flatnonzero(moved)
    if len(kept) and len(active):
        best, near = full_scan(points[kept], entries[active])
        best = active[best]
        nearer = (near < dist[kept]) | ((near == dist[kept]) & (best < code[kept]))
        code[kept[nearer]], dist[kept[nearer]] = best[nearer], near[nearer]
    return code, dist


@dataclass(frozen=True)
class Codebooks:
    """By length of vectors and part: entries as rows of whole numbers, and
    which of them moved in the last round."""

    entries: dict[int, list[np.ndarray]]
    moved: dict[int, list[np.ndarray]]
    scale: int

    def text(self) -> str:
        """All components, by length, part, entry and position."""
        books = [self.entries[length] for length in sorted(self.entries)]
        return ",".join(str(x) for book in books for part in book for x in part.ravel().tolist())

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of the rows of each length."""
    v = batch.column("v")
    offsets = v.offsets.to_numpy().astype(np.int64)
    flat = v.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        places = offsets[rows][:, None] + np.arange(length)
        yield rows, flat[places]


def first_codebooks(rows: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    """The parts of the vectors of the smallest ids, for each length; rows that
    share an id go by their components, rows without an id come last."""
    found = rows.select(F.size("v").alias("n")).distinct().limit(MOST_LENGTHS + 1).collect()
    if len(found) > MOST_LENGTHS:
        raise ValueError(f"vectors have more than {MOST_LENGTHS} lengths")
    books = {}
    for (length,) in found:
        first = (
            rows.filter(F.size("v") == length)
            .orderBy(F.asc_nulls_last("vec_id"), "v")
            .limit(entries)
            .select("v")
            .collect()
        )
        whole = np.array([r.v for r in first], np.int64).reshape(len(first), length)
        at = cuts(length, parts)
        books[length] = [whole[:, a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    moved = {n: [np.ones(len(e), bool) for e in book] for n, book in books.items()}
    return Codebooks(books, moved, scale)


def assigned(state: DataFrame, books: Codebooks, first: bool) -> DataFrame:
    """The rows with their parts' entries and distances under ``books``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            parts = len(next(iter(books.entries.values()))) if books.entries else 0
            codes = np.zeros((n, parts), np.uint8)
            dists = np.zeros((n, parts), np.int64)
            if not first and n:
                codes[:] = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, -1)
                dists[:] = batch.column("dists").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            for rows, matrix in _matrices(batch):
                length = matrix.shape[1]
                at = cuts(length, parts)
                for i, entries in enumerate(books.entries[length]):
                    points = matrix[:, at[i] : at[i + 1]]
                    if first:
                        code, dist = full_scan(points, entries)
                    else:
                        code, dist = active_scan(
                            points, entries, books.moved[length][i], codes[rows, i].astype(np.int64), dists[rows, i]
                        )
                    codes[rows, i], dists[rows, i] = code, dist
            packed = codes.tobytes()
            step = np.arange(n + 1, dtype=np.int32) * parts
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    batch.column("v"),
                    pa.array([packed[a : a + parts] for a in step[:-1]], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(step), pa.array(dists.ravel())),
                ],
                names=["vec_id", "label", "v", "codes", "dists"],
            )

    return state.mapInArrow(run, STATE)


def sums(state: DataFrame, books: Codebooks) -> DataFrame:
    """Sums and counts of the parts of each entry, by component: added up in
    each task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = {}, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8)
            codes = codes.reshape(batch.num_rows, -1)
            for rows, matrix in _matrices(batch):
                length = matrix.shape[1]
                at = cuts(length, codes.shape[1])
                for i, entries in enumerate(books.entries[length]):
                    key = length, i
                    if key not in totals:
                        totals[key] = np.zeros(entries.shape, np.int64)
                        counts[key] = np.zeros(len(entries), np.int64)
                    np.add.at(totals[key], codes[rows, i], matrix[:, at[i] : at[i + 1]])
                    counts[key] += np.bincount(codes[rows, i], minlength=len(entries))
        for (length, part), total in totals.items():
            entry, place = np.nonzero(np.broadcast_to(counts[length, part][:, None] > 0, total.shape))
            n = len(entry)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, length, np.int32)),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(entry.astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(total[entry, place]),
                    pa.array(counts[length, part][entry]),
                ],
                names=["length", "part", "entry", "place", "total", "n"],
            )

    rows = state.select("v", "codes").mapInArrow(
        run, "length int, part int, entry int, place int, total long, n long"
    )
    return rows.groupBy("length", "part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )


def moved_codebooks(state: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry at the floor of the mean of its parts; unused ones stay."""
    entries = {n: [e.copy() for e in book] for n, book in books.entries.items()}
    for row in sums(state, books).collect():
        entries[row.length][row.part][row.entry, row.place] = int(row.total) // row.n
    moved = {
        n: [(a != b).any(1) for a, b in zip(book, books.entries[n], strict=True)]
        for n, book in entries.items()
    }
    return Codebooks(entries, moved, books.scale)


def encode(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    label: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """``vec_id``, ``label`` (as text), ``v``, ``codes`` (a byte for each part)
    and ``dists`` (exact squared distances), and the codebooks.

    Vectors of another length have codebooks of their own, at most
    ``MOST_LENGTHS``; an empty vector has the code 0 and the distance 0. Fewer
    vectors than ``entries`` make smaller codebooks. Other columns are dropped.
    Components whose squared distances do not fit 64 bits are an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's number is a byte")
    rows = staged(integers(vectors, scale, label), "vectors")
    books = first_codebooks(rows, parts, entries, scale)
    state = staged(assigned(rows, books, first=True), "codes-0")
    for number in range(1, rounds + 1):
        books = moved_codebooks(state, books)
        if not any(m.any() for book in books.moved.values() for m in book):
            break  # no entry moved: all later rounds are as this one
        state = staged(assigned(state, books, first=False), f"codes-{number}")
    return state, books


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id`` and ``embedding``: the entries that the codes name, brought
    back to the components' scale (``codes`` as ``encode`` returns them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_pylist()
            named = batch.column("codes").to_pylist()
            out = [
                np.concatenate([part[c] for part, c in zip(books.entries[n], code, strict=True)]) / books.scale
                for n, code in zip(lengths, named, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(out, pa.list_(pa.float64()))], names=["vec_id", "embedding"]
            )

    sized = codes.select("vec_id", "codes", F.size("v").alias("length"))
    return sized.mapInArrow(run, "vec_id long, embedding array<double>")


def digests(vectors: DataFrame) -> DataFrame:
    """Per vector its code, error, the error summed over its label (rows
    without a label together) and the digest of the codebooks."""
    state, books = encode(vectors)
    rows = state.select(
        "vec_id",
        "label",
        F.lower(F.hex("codes")).alias("code"),
        F.aggregate("dists", F.lit(0).cast("long"), lambda a, b: a + b).alias("error"),
    )
    by_label = staged(
        rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label"),
        "label-errors",
    )
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
