"""Passages of a benchmark in documents, found through edit distance.

An item of which at most k words may be edited is cut into k + 1 pieces of words
in a row: whatever the edits are and wherever they fall, one piece at least has
none and stands in the passage word by word, at most k words off its place. So
hashes of the words in a row at every place of a document are looked up among
the pieces of all items, and around each hit the item is aligned by exact edit
distance in words. No passage is missed.

Documents are only scanned: no shuffle and nothing but matches comes out. Items
are read by blocks of a bounded number, one scan for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmill.llm.common import ids_and_texts, mix, ragged, staged, text_blocks, word_hashes, word_spans

#: Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
BREAKS = np.ones(256, bool)
BREAKS[48:58] = BREAKS[65:91] = BREAKS[97:123] = BREAKS[128:] = False

#: Words of a piece that are looked up at most, and zeros after each text.
LONGEST = 8
#: Bits of a piece's hash that the first look is by.
FILTER_BITS = 20
#: Hits that are expanded, and words of texts that are aligned, at once.
HITS, CELLS = 1 << 18, 1 << 19
#: Items of a block, and bytes of their texts.
ITEMS_PER_SCAN, ITEM_BYTES = 20_000, 16 << 20


@dataclass(frozen=True)
class Search:
    """``edits`` is the share of an item's words that may differ. Items of fewer
    than ``min_words`` words are no passages."""

    edits: float = 0.2
    min_words: int = 5

    def __post_init__(self) -> None:
        if not 0 <= self.edits < 1:
            raise ValueError("edits must be a share of the words below 1")


def padded_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words with LONGEST zeros after each text, the first word of each
    text among them, and the places of the words."""
    begins, ends, bounds = word_spans(data, offs, BREAKS)
    hashes = word_hashes(data, begins, ends)
    hashes[hashes == 0] = 1
    counts = np.diff(bounds)
    firsts = bounds[:-1] + LONGEST * np.arange(len(counts))
    places = ragged(firsts, counts)
    out = np.zeros(len(hashes) + LONGEST * len(counts), np.uint64)
    out[places] = hashes
    return out, np.append(firsts, len(out)), places


def next_key(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mix(key * np.uint64(0x9E3779B97F4A7C15) + symbol)


def slot(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


class ItemPieces:
    """A block of items and their pieces, by the words that are looked up."""

    def __init__(self, ids: list, texts: list[str], search: Search) -> None:
        raw = [x.encode() for x in texts]
        offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        self.words, firsts, _ = padded_words(np.frombuffer(b"".join(raw), np.uint8), offs)
        sizes = np.diff(firsts) - LONGEST
        use = np.flatnonzero(sizes >= max(search.min_words, 1))
        self.ids = [ids[i] for i in use]
        self.sizes, self.firsts = sizes[use], firsts[use]
        self.most = (search.edits * self.sizes).astype(np.int64)
        parts = self.most + 1
        item = np.repeat(np.arange(len(use)), parts)
        number = ragged(np.zeros(len(use), np.int64), parts)
        begin = number * self.sizes[item] // parts[item]
        length = np.minimum((number + 1) * self.sizes[item] // parts[item] - begin, LONGEST)
        self.pieces: dict[int, tuple] = {}
        for q in np.unique(length).tolist():
            these = np.flatnonzero(length == q)
            keys = np.zeros(len(these), np.uint64)
            for step in range(q):
                keys = next_key(keys, self.words[self.firsts[item[these]] + begin[these] + step])
            filter_ = np.zeros(1 << FILTER_BITS, bool)
            filter_[slot(keys)] = True
            order = np.argsort(keys, kind="stable")
            self.pieces[q] = (filter_, keys[order], item[these[order]], begin[these[order]])

    def item(self, which: int) -> np.ndarray:
        return self.words[self.firsts[which] : self.firsts[which] + self.sizes[which]]

    def hits(self, words: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Places where a piece stands, its item, and where the item would start."""
        key = np.zeros(len(places), np.uint64)
        for q in range(1, max(self.pieces, default=0) + 1):
            key = next_key(key, words[places + q - 1])
            if q not in self.pieces:
                continue
            filter_, known, items, begins = self.pieces[q]
            some = np.flatnonzero(filter_[slot(key)])
            a = np.searchsorted(known, key[some], "left")
            counts = np.searchsorted(known, key[some], "right") - a
            some, a, counts = some[counts > 0], a[counts > 0], counts[counts > 0]
            sums, lo = np.cumsum(counts), 0
            while lo < len(some):
                before = sums[lo] - counts[lo]
                hi = max(lo + 1, int(np.searchsorted(sums, before + HITS, "right")))
                which = ragged(a[lo:hi], counts[lo:hi])
                place = np.repeat(places[some[lo:hi]], counts[lo:hi])
                yield place, items[which], place - begins[which]
                lo = hi

    def align(
        self, words: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits that turn each item into words in a row between begin
        and end, and the first place where such words start."""
        edits, starts = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        order = np.argsort(self.sizes[item], kind="stable")
        widths = np.maximum.accumulate((end - begin)[order])
        lo = 0
        while lo < len(order):
            fits = widths[lo:] * np.arange(1, len(order) - lo + 1) <= CELLS
            hi = lo + max(1, int(fits.sum()))
            some = order[lo:hi]
            edits[some], starts[some] = self._align(words, item[some], begin[some], end[some])
            lo = hi
        return edits, starts

    def _align(
        self, words: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        # Items of ascending sizes. Both are read from their ends, so that the
        # last row holds the fewest edits by start.
        n, width = self.sizes[item], end - begin
        steps = np.arange(int(width.max()) + 1)
        at = end[:, None] - 1 - steps[:-1]
        text = np.where(steps[:-1] < width[:, None], words[np.maximum(at, 0)], np.uint64(0))
        row = np.zeros((len(item), len(steps)), np.int64)
        edits, starts = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        lo = 0
        for i in range(int(n[-1])):
            symbol = self.words[self.firsts[item[lo:]] + n[lo:] - 1 - i]
            best = np.full_like(row, i + 1)
            best[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (text != symbol[:, None]))
            row = np.minimum.accumulate(best - steps, axis=1) + steps
            hi = int(np.searchsorted(n, i + 1, "right"))
            if hi > lo:
                ends = row[: hi - lo]
                ends = np.where(steps <= width[lo:hi, None], ends, i + 2)
                edits[lo:hi] = ends.min(1)
                last = steps[-1] - (ends == edits[lo:hi, None])[:, ::-1].argmax(1)
                starts[lo:hi] = end[lo:hi] - last
                row, text, lo = row[hi - lo :], text[hi - lo :], hi
        return edits, starts

    def passages(
        self, words: np.ndarray, firsts: np.ndarray, places: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """Texts and items with a passage, and of its place with the fewest
        edits, of ties the first, the edits and the start."""
        found = [np.zeros((0, 4), np.int64)]
        for place, item, start in self.hits(words, places):
            text = np.searchsorted(firsts, place, "right") - 1
            text, item, start = np.unique(np.stack([text, item, start], 1), axis=0).T
            most = self.most[item]
            begin = np.maximum(start - most, firsts[text])
            end = np.minimum(start + self.sizes[item] + most, firsts[text + 1] - LONGEST)
            edits, start = self.align(words, item, begin, end)
            found.append(np.stack([text, item, edits, start], 1)[edits <= most])
        rows = np.unique(np.concatenate(found), axis=0)
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        return tuple(rows[new].T)


def edit_distance(item: np.ndarray, window: np.ndarray, most: int) -> tuple[int, int]:
    """Fewest edits, up to ``most``, that turn the item into a beginning of the
    window, and the length of the shortest such beginning; (most + 1, 0) if none."""
    n = len(item)
    if len(window) >= n and np.array_equal(item, window[:n]):
        return 0, n
    if np.isin(item, window).sum() < n - most:
        return most + 1, 0
    row = np.arange(len(window) + 1)
    steps = np.arange(len(window) + 1)
    for i in range(n):
        best = np.minimum(row[1:] + 1, row[:-1] + (window != item[i]))
        best = np.concatenate([[i + 1], best])
        # Insertions along the row, as a running minimum.
        row = np.minimum.accumulate(best - steps) + steps
        if row.min() > most:
            return most + 1, 0
    end = int(row.argmin())
    return (int(row[end]), end) if row[end] <= most else (most + 1, 0)


def _scan(documents: DataFrame, items: ItemPieces, item_type: T.DataType) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("item_id", item_type),
            *[T.StructField(c, T.LongType()) for c in ("start_word", "end_word", "item_words", "edits")],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        names = to_arrow_schema(schema)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for lo, _, data, offs in text_blocks(batch):
                words, firsts, places = padded_words(data, offs)
                rows = []
                found = np.stack(items.passages(words, firsts, places), 1)
                for text, item, _, place in found.tolist():
                    n, most = int(items.sizes[item]), int(items.most[item])
                    end = min(place + n + most, int(firsts[text + 1]) - LONGEST)
                    edits, length = edit_distance(items.item(item), words[place:end], most)
                    start = place - int(firsts[text])
                    rows.append((ids[lo + text], items.ids[item], start, start + length, n, edits))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), names, strict=True)],
                        schema=names,
                    )

    return documents.mapInArrow(run, schema)


def _blocks(benchmark: DataFrame, search: Search) -> tuple[int, Iterator[ItemPieces]]:
    """The number of blocks of items, and each when it is asked for. Repeated
    rows are one item; blocks go by id and text, so that no id fills one."""
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null").distinct()
    rows, n_bytes = items.select(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    blocks = max(1, -(-rows // ITEMS_PER_SCAN), -(-(n_bytes or 0) // ITEM_BYTES))

    def block(number: int) -> ItemPieces:
        some = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        some = sorted(some, key=lambda r: (r.item_id, r.text))
        return ItemPieces([r.item_id for r in some], [r.text for r in some], search)

    return blocks, map(block, range(blocks))


def passages(
    documents: DataFrame, benchmark: DataFrame, search: Search | None = None, text: str = "text"
) -> DataFrame:
    """One row for each document and benchmark item whose words the document
    holds with at most ``edits`` of them changed: ``doc_id``, ``item_id``,
    ``start_word`` and ``end_word`` of the place with the fewest edits (of ties
    the first), ``item_words`` and ``edits``.

    Words are compared without punctuation and without regard to the case of
    A-Z. NULL and empty texts and items have no words and no matches. Repeated
    documents come out each, items of the same text too, an item that is repeated
    with its id and text once. Items without an id are left out, since no row
    could name them.
    """
    documents = ids_and_texts(documents, text)
    item_type = benchmark.schema["item_id"].dataType
    blocks, parts = _blocks(benchmark, search or Search())
    found = []
    for pieces in parts:
        scan = _scan(documents, pieces, item_type)
        found.append(scan if blocks == 1 else staged(scan, "passages"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _without(documents: DataFrame, items: ItemPieces) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for lo, _, data, offs in text_blocks(batch):
                keep[lo + items.passages(*padded_words(data, offs))[0]] = False
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)


def clean_documents(documents: DataFrame, benchmark: DataFrame, search: Search | None = None) -> DataFrame:
    """Rows whose text holds no passage of the benchmark, all columns as they
    are. Each row is judged by its own text, whatever its id is and whoever
    shares it; items without an id are left out as in ``passages``."""
    blocks, parts = _blocks(benchmark, search or Search())
    for number, pieces in enumerate(parts, 1):
        documents = _without(documents, pieces)
        if number < blocks:
            documents = staged(documents, "without-passages")
    return documents
