"""A Katz back-off model of word pairs, and the score of every document by it.

    p(w | h) = d(c(h, w)) * c(h, w) / n(h)   if h w was seen in training
             = a(h) * p(w)                   if not, and h was seen
             = p(w)                          if h was never seen
    p(w)     = d(c(w)) * c(w) / N            if w was seen
             = what the discounts leave      for the unknown word

Discounts d are Good-Turing up to counts of ``KEPT``. a(h) makes the
probabilities after h add up to one exactly: it is what the seen words leave,
over the unigram probability of the words not seen after h. A history whose
followers are all frequent would leave nothing, and one of more than ``LARGE``
occurrences next to nothing, so those keep one occurrence for the rest: n(h) is
c(h) + 1 there and c(h) elsewhere.

Counts are gathered over all training documents. Documents are numbered by
chunks, so that words and pairs are counted within a chunk before they travel:

1. A chunk's distinct words meet in buckets of their hash. The counts and
   numbers of the words, stored by bucket, come back to the chunks.
2. A chunk's distinct pairs, with the documents that they stand in, meet in
   buckets of their history. A history with many occurrences is spread over
   several buckets by the following word. The places of a pair that is frequent
   in a chunk stay with the chunk, which sends one place for all of them, so no
   bucket gathers all places of a frequent pair. A bucket has all it needs to
   know of its pairs; what depends on discounts is left open and stored, by bucket.
3. With the discounts known, every bucket's share of every document is worked
   out, and the shares are added up by chunk.

Buckets are sized by the bytes of all texts. The driver sees sums, discounts
and the weights of spread histories, of which there are at most four for each
bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.llm.common import (
    FOLDED,
    buckets,
    mix,
    ragged,
    staged,
    text_blocks,
    text_bytes,
    word_hashes,
    word_spans,
)
from loanmill.llm.exchange import bucket_of

KEPT, LARGE = 5, 1000
#: Tokens of a chunk, and bytes of text for each bucket.
CHUNK, BUCKET_BYTES = 1_300_000, 9 << 20
#: Cells of a stored row of shares, and a writer's bytes of a row group where
#: rows are large: a reader holds all rows of a group at a time.
PIECE = 1 << 18
SMALL_GROUPS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}
#: The hash that stands for the end of a text; numbers of the unknown word and
#: of the beginning, which is a history only.
END, UNKNOWN, BEGIN = np.uint64(0x9D8A7C6B5E4F3021), 0, 1


# ------------------------------------------------------------------ small tools


def planes(x: np.ndarray, width: int = 5) -> bytes:
    """Whole numbers below 256**width, all lowest bytes first: high bytes are
    mostly zero and compress to nothing."""
    return np.ascontiguousarray(x, "<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplanes(blob: bytes, width: int = 5) -> np.ndarray:
    parts = np.frombuffer(blob, np.uint8).reshape(width, -1)
    out = np.zeros(parts.shape[1], "<i4" if width == 4 else "<i8")
    out.view(np.uint8).reshape(-1, out.itemsize)[:, :width] = parts.T
    return out


def width_of(x: np.ndarray) -> int:
    """Bytes that the largest of the numbers needs."""
    return max(1, -(-int(x.max(initial=0)).bit_length() // 8))


def discounts(seen: list[int]) -> np.ndarray:
    """Good-Turing discounts of counts 0 to KEPT, from the numbers of types that
    occur 1 to KEPT + 1 times. Where those give none between 0 and 1, half an
    occurrence is taken off."""
    n = [0, *seen]
    common = (KEPT + 1) * n[KEPT + 1] / n[1] if n[1] else 1.0
    out = np.ones(KEPT + 1)
    for r in range(1, KEPT + 1):
        d = 0.0
        if n[r] and common < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


@dataclass(frozen=True)
class Unigrams:
    """Tokens, types and documents of the training texts, and discounts."""

    tokens: int
    types: int
    documents: int
    seen: tuple[int, ...]

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        """Probability of words by their counts; 0 is the unknown word."""
        d = discounts(list(self.seen))
        freed = sum(n * r * (1 - d[r]) for r, n in enumerate(self.seen[:KEPT], 1))
        total = self.tokens + (0 if freed else 1)
        kept = np.where(counts <= KEPT, d[np.minimum(counts, KEPT)], 1.0) * counts
        return np.where(counts > 0, kept, freed or 1) / max(total, 1)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.types + 1))


# ------------------------------------------------------------- chunks and words

_CHUNK_SCHEMA = (
    "chunk long, ids binary, flags binary, sizes binary, words binary, counts binary, "
    "place binary, codes binary"
)


def _chunks(documents: DataFrame, n_buckets: int) -> DataFrame:
    """Documents (doc_id, text, train) as rows of coded tokens. A chunk's words
    are numbered by frequency; ``place`` is the bucket of each."""

    def coded(held: list, number: int) -> pa.RecordBatch:
        ids, named, train, sizes, tokens = map(np.concatenate, zip(*held, strict=True))
        words, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        code = np.empty(len(order), np.int64)
        code[order] = np.arange(len(order))
        codes, words = code[inverse], words[order]
        trained = np.bincount(codes[np.repeat(train, sizes)], minlength=len(words))
        row = [
            pa.array([TaskContext.get().partitionId() << 32 | number], pa.int64()),
            *(
                pa.array([x], pa.binary())
                for x in (
                    ids.astype("<i8").tobytes(),
                    (train + 2 * named).astype(np.uint8).tobytes(),
                    planes(sizes),
                    words.astype("<u8").tobytes(),
                    planes(trained),
                    planes(bucket_of(words, n_buckets), 4),
                    planes(codes, 4),
                )
            ),
        ]
        names = [x.split()[0] for x in _CHUNK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(row, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, number = [], 0, 0
        for batch in batches:
            ids = batch.column("doc_id")
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy(zero_copy_only=False)
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, data, offs in text_blocks(batch):
                begins, ends, bounds = word_spans(data, offs)
                sizes = np.diff(bounds) + 1
                tokens = np.full(int(sizes.sum()), END, np.uint64)
                tokens[ragged(np.cumsum(sizes) - sizes, sizes - 1)] = word_hashes(data, begins, ends, FOLDED)
                held.append((values[lo:hi], named[lo:hi], train[lo:hi], sizes, tokens))
                n += len(tokens)
                if n >= CHUNK:
                    yield coded(held, number)
                    held, n, number = [], 0, number + 1
        if held:
            yield coded(held, number)

    return documents.mapInArrow(run, _CHUNK_SCHEMA)


def _words(chunks: DataFrame, n_buckets: int) -> DataFrame:
    """The stored counts: for each chunk and bucket the numbers and counts of
    the chunk's words, in its order; and, without a chunk, sums of a bucket."""

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words = np.frombuffer(batch.column("words")[row].as_py(), "<u8")
                counts = unplanes(batch.column("counts")[row].as_py())
                place = unplanes(batch.column("place")[row].as_py(), 4)
                order = np.argsort(place, kind="stable")
                cuts = np.flatnonzero(np.diff(place[order], prepend=-1))
                ends = np.append(cuts, len(order))[1:]
                parts = [order[a:b] for a, b in zip(cuts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(place[p[0]]) for p in parts], pa.int32()),
                        pa.array([batch.column("chunk")[row].as_py()] * len(parts), pa.int64()),
                        pa.array([words[p].tobytes() for p in parts], pa.binary()),
                        pa.array([planes(counts[p]) for p in parts], pa.binary()),
                    ],
                    names=["bucket", "chunk", "words", "counts"],
                )

    def numbered(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        parts = [np.frombuffer(x, "<u8") for x in table.column("words").to_pylist()]
        counts = np.concatenate([unplanes(x) for x in table.column("counts").to_pylist()])
        words, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(inverse, counts, len(words)).astype(np.int64)
        order = np.argsort(-total, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        number = np.where(total > 0, rank * n_buckets + bucket + 2, UNKNOWN)
        ends = np.cumsum([len(p) for p in parts])[:-1]
        small = np.bincount(np.minimum(total, KEPT + 2), minlength=KEPT + 3)
        sums = [int(total.sum()), int((total > 0).sum()), int(total[words == END].sum())]
        rows = len(parts)
        return pa.table(
            {
                "bucket": pa.array([bucket] * (rows + 1), pa.int32()),
                "chunk": pa.concat_arrays([table.column("chunk").combine_chunks(), pa.array([None], pa.int64())]),
                "numbers": pa.array([*(planes(x) for x in np.split(number[inverse], ends)), None], pa.binary()),
                "counts": pa.array([*(planes(x) for x in np.split(total[inverse], ends)), None], pa.binary()),
                "sums": pa.array([*([None] * rows), [*sums, *small[1 : KEPT + 2].tolist()]], pa.list_(pa.int64())),
            }
        )

    sent = chunks.select("chunk", "words", "counts", "place").mapInArrow(
        requests, "bucket int, chunk long, words binary, counts binary"
    )
    return sent.groupBy("bucket").applyInArrow(
        numbered, "bucket int, chunk long, numbers binary, counts binary, sums array<long>"
    )


def _summed(rows: DataFrame, size: int) -> list[int]:
    row = rows.agg(*[F.sum(F.col("sums")[i]) for i in range(size)]).first()
    return [int(x or 0) for x in row]


# ------------------------------------------------------------------------ pairs

_PAIR_SCHEMA = "bucket long, chunk long, histories binary, pairs binary, places binary, docs binary"


def _pairs(
    unigrams: Unigrams, n_buckets: int, spread: int, often: int, chunk: pa.Table, words: pa.Table
) -> pa.Table:
    """A chunk's distinct pairs for the buckets of their histories, and one row
    below zero with its documents and what is known of their scores.

    A pair of more than ``often`` places is sent with one place, in a document
    of its own after the chunk's; the row below zero keeps its real ones."""
    row = {name: chunk.column(name)[0].as_py() for name in chunk.column_names}
    place = unplanes(row["place"], 4)
    number, count = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    order = np.argsort(place, kind="stable")
    answers = sorted(
        zip(*(words.column(c).to_pylist() for c in ("bucket", "numbers", "counts")), strict=True)
    )
    number[order] = np.concatenate([unplanes(x[1]) for x in answers])
    count[order] = np.concatenate([unplanes(x[2]) for x in answers])

    codes, sizes = unplanes(row["codes"], 4), unplanes(row["sizes"])
    train = np.frombuffer(row["flags"], np.uint8) & 1
    n = len(sizes)
    doc = np.repeat(np.arange(n, dtype=np.int32), sizes)
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[np.cumsum(sizes) - sizes] = -1
    number_of, count_of = np.append(number, BEGIN), np.append(count, unigrams.documents)
    seen = (count_of > 0)[before]
    rest = np.flatnonzero(~seen)
    scores = np.concatenate(
        [
            np.bincount(doc, unigrams.base(count)[codes], n),
            np.bincount(doc[rest], np.log10(unigrams.probabilities(count))[codes[rest]], n),
        ]
    )
    known = np.bincount(doc[(count > 0)[codes]], minlength=n)

    at = np.flatnonzero(seen).astype(np.int32)
    pair = (before[at].astype(np.int64) + 1) * (len(place) + 1) + codes[at]
    order = np.argsort(pair, kind="stable")
    at, pair = at[order], pair[order]
    new = np.ones(len(pair), bool)
    new[1:] = pair[1:] != pair[:-1]
    first = np.flatnonzero(new)
    del order, pair, new, seen, rest
    times = np.diff(np.append(first, len(at)))
    history, word, places = before[at[first]], codes[at[first]], doc[at]
    del before, codes, doc, at
    trained = np.add.reduceat(train[places], first, dtype=np.int64) if len(first) else first
    many = np.flatnonzero(times > often)
    kept, repeats = np.unique(
        np.repeat(np.arange(len(many)), times[many]) * n + places[ragged(first[many], times[many])],
        return_counts=True,
    )
    places[first[many]] = n + np.arange(len(many))
    times[many] = 1
    salts = 1 + count_of[history] // spread * (count_of[history] > spread)
    salt = mix(number[word].astype(np.uint64)) % salts.astype(np.uint64)
    bucket = bucket_of(mix(number_of[history].astype(np.uint64) * np.uint64(65537) + salt), n_buckets)
    del salts, salt
    by = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by], prepend=-1))
    out: list[tuple] = [
        (
            -1 - row["chunk"],
            row["chunk"],
            planes(sizes),
            planes(known),
            scores.astype("<f8").tobytes(),
            row["flags"] + row["ids"] + planes(np.concatenate([np.diff(kept, prepend=0), repeats])),
        )
    ]
    for a, b in zip(cuts, np.append(cuts, len(by))[1:], strict=True):
        some = by[a:b]
        h = history[some]
        turn = np.flatnonzero(np.diff(h, prepend=-2))
        runs = np.diff(np.append(turn, len(some)))
        w = word[some]
        out.append(
            (
                int(bucket[some[0]]),
                row["chunk"],
                planes(number_of[h[turn]]) + planes(count_of[h[turn]]) + planes(runs),
                planes(number[w]) + planes(count[w]) + planes(trained[some]) + planes(times[some]),
                planes(places[ragged(first[some], times[some])], 4),
                None,
            )
        )
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
    names = [x.split()[0] for x in _PAIR_SCHEMA.split(", ")]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


_SHARE_SCHEMA = (
    "bucket long, chunk long, chunks binary, cells binary, sure binary, classes binary, "
    "unseen binary, histories binary, freed binary, sums array<long>"
)


def _shares(unigrams: Unigrams, spread: int, large: int, piece: int, table: pa.Table) -> pa.Table:
    """What a bucket knows of the documents: ``cells`` (chunk, document) with
    the ``sure`` part of their scores, and how often they hold pairs of each
    small count, whose discount is still to come; ``unseen`` pairs as cell and
    history; and for those histories what their weight depends on. A row has up
    to ``piece`` cells; what is summed over all buckets stands in the first one."""
    if table.column("bucket")[0].as_py() < 0:
        row = table.to_pylist()[0]
        values = [row["bucket"], row["chunk"], row["docs"], row["histories"], row["places"], row["pairs"]]
        return _share_rows([[*values, None, None, None, None]])
    parts = [np.frombuffer(x, np.uint8).reshape(15, -1) for x in table.column("histories").to_pylist()]
    h_number, h_count, runs = (
        np.concatenate([unplanes(p[5 * i : 5 * i + 5].tobytes()) for p in parts]) for i in range(3)
    )
    parts = [np.frombuffer(x, np.uint8).reshape(20, -1) for x in table.column("pairs").to_pylist()]
    number, count, trained, times = (
        np.concatenate([unplanes(p[5 * i : 5 * i + 5].tobytes()) for p in parts]) for i in range(4)
    )
    chunk = np.repeat(np.arange(len(parts), dtype=np.int32), [p.shape[1] for p in parts])
    del parts
    run = np.repeat(np.arange(len(runs), dtype=np.int32), runs)

    # All records of a pair, and all pairs of a history, side by side.
    h = h_number[run]
    order = np.lexsort((number, h))
    h, w = h[order], number[order]
    new_h = np.ones(len(order), bool)
    new_h[1:] = h[1:] != h[:-1]
    new = new_h.copy()
    new[1:] |= w[1:] != w[:-1]
    first = np.flatnonzero(new)
    # The unknown word is many words: a pair with it is never seen.
    total = np.where(w[first] == UNKNOWN, 0, np.add.reduceat(trained[order], first))
    del h, w, number, trained
    of_h = (np.cumsum(new_h) - 1)[first]
    heads = order[np.flatnonzero(new_h)]
    n_h = len(heads)
    p = unigrams.probabilities(count[order[first]])
    is_seen = total > 0
    small = np.zeros((n_h, KEPT), np.int64)
    for r in range(1, KEPT + 1):
        small[:, r - 1] = np.bincount(of_h[total == r], minlength=n_h)
    covered = np.bincount(of_h[is_seen], p[is_seen], n_h)
    head_number, c_h = h_number[run[heads]], h_count[run[heads]]
    keeps_one = (c_h > large) | ~small.any(1)
    del count, run, heads, h_number, h_count

    # Back to records, and from them to occurrences.
    log_n = np.log10(c_h + keeps_one)
    with np.errstate(divide="ignore"):
        sure_of = np.where(is_seen, np.log10(np.maximum(total, 1)) - log_n[of_h], np.log10(p))
    group = np.cumsum(new) - 1
    r, head, sure = (np.empty(len(order), x) for x in (np.int8, np.int32, float))
    r[order] = np.minimum(total, KEPT + 1)[group]
    head[order] = of_h[group]
    sure[order] = sure_of[group]
    del order, group, new, new_h, first, of_h, p, is_seen, sure_of
    of_record = np.repeat(np.arange(len(times), dtype=np.int32), times)
    doc = np.concatenate([unplanes(x, 4) for x in table.column("places").to_pylist()])
    width = int(doc.max(initial=0)) + 1
    doc = chunk[of_record].astype(np.int64) * width + doc
    cells, cell = np.unique(doc, return_inverse=True)
    del doc, chunk, times
    n = len(cells)
    values = np.bincount(cell, sure[of_record], n)
    r_occ = r[of_record]
    classes = np.stack([np.bincount(cell[r_occ == k], minlength=n) for k in range(1, KEPT + 1)])
    unseen = np.flatnonzero(r_occ == 0)
    unseen = unseen[np.argsort(cell[unseen], kind="stable")]
    cell, head = cell[unseen], head[of_record[unseen]]
    del of_record, r_occ, sure, r, unseen
    is_spread = c_h > spread
    counts = np.bincount(np.minimum(total, KEPT + 2), minlength=KEPT + 3)
    bucket = table.column("bucket")[0].as_py()
    chunks = np.array(table.column("chunk").to_pylist(), "<i8").tobytes()
    rows = []
    for a in range(0, n, piece):
        own, in_class = cells[a : a + piece], classes[:, a : a + piece]
        i, j = np.searchsorted(cell, [a, a + piece])
        needed = np.zeros(n_h, bool)
        needed[head[i:j]] = True
        if not a:
            needed |= is_spread
        keep = np.flatnonzero(needed)
        summed = (~is_spread[keep] | (a == 0)).astype(np.int64)
        number_in = (np.cumsum(needed) - 1)[head[i:j]]
        place = np.concatenate([own // width, own % width])
        rows.append(
            [
                bucket,
                None,
                chunks,
                planes(place, width_of(place)),
                values[a : a + piece].astype("<f8").tobytes(),
                planes(in_class.ravel(), width_of(in_class)),
                planes(np.concatenate([cell[i:j] - a, number_in]), 4),
                planes(head_number[keep]) + planes(c_h[keep]) + planes((small[keep].T * summed).ravel()),
                (covered[keep] * summed).astype("<f8").tobytes() + keeps_one[keep].tobytes(),
                None if a else counts[1 : KEPT + 2].tolist(),
            ]
        )
    return _share_rows(rows)


def _share_rows(rows: list[list]) -> pa.Table:
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 7, pa.list_(pa.int64())]
    names = [x.split()[0] for x in _SHARE_SCHEMA.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _histories(row: dict) -> tuple[np.ndarray, ...]:
    """Number, count, followers of each small count, sum of the followers'
    unigram probabilities, and whether one occurrence is kept."""
    blob = np.frombuffer(row["histories"], np.uint8)
    n = len(blob) // (10 + 5 * KEPT)
    number, count = unplanes(blob[: 5 * n].tobytes()), unplanes(blob[5 * n : 10 * n].tobytes())
    small = unplanes(blob[10 * n :].tobytes()).reshape(KEPT, n).T if n else np.zeros((0, KEPT), np.int64)
    covered = np.frombuffer(row["freed"][: 8 * n], "<f8")
    return number, count, small, covered, np.frombuffer(row["freed"][8 * n :], bool)


def weights(
    count: np.ndarray, small: np.ndarray, covered: np.ndarray, keeps_one: np.ndarray, d: np.ndarray
) -> np.ndarray:
    """log10 of the back-off weights: what the discounts leave of a history,
    over what the unseen words have among unigrams."""
    r = np.arange(1, KEPT + 1)
    left = (small * (r * (1 - d[1:]))).sum(1) + keeps_one
    return np.log10(left / (count + keeps_one)) - np.log10(1 - covered)


def _spread_weights(shares: DataFrame, spread: int, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and weights of the histories that lie in several buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                number, count, small, covered, _ = _histories(row)
                some = np.flatnonzero(count > spread)
                columns = [number[some], count[some], *small[some].T, covered[some]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    few = [f"n{r}" for r in range(1, KEPT + 1)]
    names = ["number", "count", *few, "covered"]
    schema = ", ".join(f"{c} long" for c in names[:-1]) + ", covered double"
    parts = shares.filter("bucket >= 0").select("histories", "freed").mapInArrow(run, schema)
    rows = (
        parts.groupBy("number", "count")
        .agg(*[F.sum(c).alias(c) for c in [*few, "covered"]])
        .orderBy("number")
        .collect()
    )
    small = np.array([[r[c] for c in few] for r in rows], np.int64).reshape(-1, KEPT)
    count = np.array([r["count"] for r in rows], np.int64)
    covered = np.array([r.covered for r in rows], float)
    # Every spread history is large, so it keeps one occurrence.
    out = weights(count, small, covered, np.ones(len(rows), bool), d)
    return np.array([r.number for r in rows], np.int64), out


def score(documents: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """Train on the documents for which ``training`` holds and score them all.

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (an
    add-one unigram model) and ``score``, the model's log10 probability of the
    whole text. A NULL or empty text is its end alone. A document for which
    ``training`` is NULL is held out. Rows are documents: repeated ones count
    and come out each. Without training texts every token is the unknown word,
    whose probability is one.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.coalesce(training, F.lit(False)).alias("train"),
    )
    n_buckets = buckets(text_bytes(rows), BUCKET_BYTES)
    chunks = staged(_chunks(rows, n_buckets), "chunks", **SMALL_GROUPS)
    words = staged(_words(chunks, n_buckets), "words")
    tokens, types, n_documents, *seen = _summed(words, KEPT + 4)
    unigrams = Unigrams(tokens, types, n_documents, tuple(seen))
    spread = max(LARGE, tokens // (4 * n_buckets))
    often = max(1, spread // max(1, chunks.count()))

    answers = words.filter("chunk is not null").select("chunk", "bucket", "numbers", "counts")
    pairs = (
        chunks.drop("words", "counts")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(lambda a, b: _pairs(unigrams, n_buckets, spread, often, a, b), _PAIR_SCHEMA)
    )
    shares = staged(
        pairs.groupBy("bucket").applyInArrow(lambda x: _shares(unigrams, spread, LARGE, PIECE, x), _SHARE_SCHEMA),
        "shares",
        **SMALL_GROUPS,
    )
    d = discounts(_summed(shares, KEPT + 1))
    spread_numbers, spread_weights = _spread_weights(shares, spread, d)

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["chunk", "docs", "values", "sizes", "known"]
        kinds = [pa.int64(), *[pa.binary()] * 4]
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] < 0:
                    out = [(row["chunk"], row["chunks"], row["sure"], row["cells"], row["classes"])]
                else:
                    out = _settled_cells(row)
                columns = zip(*out, strict=True) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

    def _settled_cells(row: dict) -> list[tuple]:
        chunk_ids = np.frombuffer(row["chunks"], "<i8")
        values = np.frombuffer(row["sure"], "<f8").copy()
        chunk, doc = unplanes(row["cells"], len(row["cells"]) // (2 * len(values))).reshape(2, -1)
        classes = unplanes(row["classes"], len(row["classes"]) // (KEPT * len(values)))
        values += np.log10(d[1:]) @ classes.reshape(KEPT, -1)
        number, count, small, covered, keeps_one = _histories(row)
        log_weight = np.zeros(len(number))
        own = count <= spread
        log_weight[own] = weights(count[own], small[own], covered[own], keeps_one[own], d)
        log_weight[~own] = spread_weights[np.searchsorted(spread_numbers, number[~own])]
        cell, history = unplanes(row["unseen"], 4).reshape(2, -1)
        values += np.bincount(cell, log_weight[history], len(values))
        cuts = np.flatnonzero(np.diff(chunk, prepend=-1))
        return [
            (int(chunk_ids[chunk[a]]), planes(doc[a:b], 4), values[a:b].tobytes(), None, None)
            for a, b in zip(cuts, np.append(cuts, len(chunk))[1:], strict=True)
        ]

    def added(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["sizes"] is not None)
        sizes, known = unplanes(head["sizes"]), unplanes(head["known"])
        n = len(sizes)
        base, total = np.frombuffer(head["values"], "<f8").reshape(2, -1).copy()
        flags = np.frombuffer(head["docs"][:n], np.uint8)
        ids = np.frombuffer(head["docs"][n : 9 * n], "<i8")
        gaps, repeats = unplanes(head["docs"][9 * n :]).reshape(2, -1)
        pair, doc = np.divmod(np.cumsum(gaps), n)
        total = np.append(total, np.zeros(pair.max(initial=-1) + 1))
        for row in sorted((r for r in rows if r["sizes"] is None), key=lambda r: (r["docs"], r["values"])):
            total[unplanes(row["docs"], 4)] += np.frombuffer(row["values"], "<f8")
        total = total[:n] + np.bincount(doc, total[n:][pair] * repeats, n)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=flags & 2 == 0),
                "held_out": pa.array(flags & 1 == 0),
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(known),
                "base_score": pa.array(base),
                "score": pa.array(total),
            }
        )

    shared = shares.drop("sums").mapInArrow(
        settled, "chunk long, docs binary, values binary, sizes binary, known binary"
    )
    return (
        shared.groupBy("chunk")
        .applyInArrow(
            added,
            "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
        )
        .withColumn("train_tokens", F.lit(tokens).cast("long"))
        .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    )
