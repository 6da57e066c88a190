"""Token ids of documents in Parquet files, for reading some of them quickly.

A dataset is a folder of two tables:

- ``tokens``: one row per document in ascending order of ``doc_id``, within files
  and from file to file: ``part`` (the number of the file's range), ``doc_id``,
  ``start`` (tokens before it in its part), ``n_tokens`` and the list ``ids``.
  Ids are dictionary encoded (16 bits or less each before compression); doc_id,
  start and n_tokens ascend or are small and are delta encoded. Row groups and
  pages are small and have page indexes, so a filter by doc_id or by start skips
  pages, and a read of the other columns never touches the ids.
- ``parts``: of each part its first and last id, its documents and tokens, and
  ``first``, the tokens of all parts before it. ``first + start`` is a
  document's place in the whole stream.

Texts are encoded where they are scanned and do not move; rows of ids are range
sorted by doc_id once. Spark writes and reads the files, wherever they lie.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanmill.llm.common import ragged, staged, work_folder

#: Words that begin and end in no kind of space. U+180E and the separators 1C to
#: 1F are spaces in some versions of Unicode only.
_SOLID = re.compile(r"[^\s\u180e\x1c-\x1f](?:.*[^\s\u180e\x1c-\x1f])?", re.S)
#: Characters whose kind no version of Unicode changes: Latin letters, digits and
#: marks without the apostrophe. Plain words have these and line feeds between them.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
_PLAIN = f"[{_LETTERS}0-9{_MARKS}]+"
_PLAIN = f"^{_PLAIN}(\\n{_PLAIN})*$"
#: Their pieces by the pattern of byte-level vocabularies.
_PIECE = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n")
#: Words whose ids a worker remembers, and the longest of them; pieces of so few
#: letters are remembered too.
REMEMBERED, LONGEST, SHORT = 400_000, 64, 4
#: Bytes of texts that are encoded together.
TOGETHER = 12 << 20
#: Parts whose tokens are added up in one group.
PARTS_TOGETHER = 1024


@dataclass(frozen=True)
class Layout:
    """Sizes in the files: tokens of a part, bytes of a row group before
    compression, rows and bytes of a page."""

    part_tokens: int = 8_000_000
    group_bytes: int = 16 << 20
    page_rows: int = 1000
    page_bytes: int = 256 << 10

    def options(self) -> dict[str, str]:
        """Settings of Spark's Parquet writer."""
        return {
            "compression": "zstd",
            "parquet.writer.version": "PARQUET_2_0",  # delta encodings
            "parquet.block.size": str(self.group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            "parquet.dictionary.page.size": str(1 << 20),
            "parquet.enable.dictionary": "true",
            **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "start", "n_tokens")},
        }


def _byte_letters() -> np.ndarray:
    """The letter that byte-level vocabularies write for each byte: visible
    Latin-1 characters stand for themselves, all others follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = np.arange(256, dtype="<u2")
    rest = [b for b in range(256) if b not in own]
    letters[rest] = 256 + np.arange(len(rest))
    return letters


class Encoder:
    """Whole texts to ids with a file of the tokenizers library.

    No piece of the vocabulary's pattern goes over a single space between two
    solid characters, so words have the same ids wherever they stand, and the
    library gets each distinct word of a block once; ids of words are
    remembered. Plain words reach its model piece by piece. Texts with other
    spaces and words that are not plain go through the library's whole pipeline
    as they are. What looks like a special token is ordinary text.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.model = self.library.model
        self.letters = _byte_letters()
        self.letters[9] = 9  # a tab is between pieces
        self.known: dict[str, bytes] = {}
        self.short: dict[str, list[int]] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids through the library's own pipeline."""
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def plain(self, words: list[str]) -> list[bytes]:
        """Ids of plain words, each after a space."""
        pieces = [" " + w if w.isalpha() else "\t".join(_PIECE.findall(" " + w)) for w in words]
        text = "\t".join(pieces).encode()
        letters = self.letters[np.frombuffer(text, np.uint8)].tobytes().decode("utf-16-le")
        found, counts, tokenize = array("I"), array("I"), self.model.tokenize
        short = self.short
        for piece in letters.split("\t"):
            ids = short.get(piece)
            if ids is None:
                ids = [t.id for t in tokenize(piece)]
                if len(piece) <= SHORT:
                    short[piece] = ids
            found.extend(ids)
            counts.append(len(ids))
        if len(short) > REMEMBERED // 4:
            short.clear()
        last = np.cumsum([piece.count("\t") + 1 for piece in pieces]) - 1
        ends = (4 * np.cumsum(counts)[last]).tolist()
        packed = found.tobytes()
        return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def learn(self, words: list[str], is_plain: np.ndarray, often: np.ndarray) -> list[bytes]:
        """Ids of the words, each after a space. Those that a block has several
        times are remembered: the others hardly ever come again."""
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        out = list(map(self.known.get, words))
        new = np.array([i for i, ids in enumerate(out) if ids is None], np.int64)
        for kind, found in ((True, self.plain), (False, self._after_space)):
            some = new[is_plain[new] == kind].tolist()
            if some:
                for i, ids in zip(some, found([words[i] for i in some]), strict=True):
                    out[i] = ids
                    if often[i] and len(words[i]) <= LONGEST:
                        self.known[words[i]] = ids
        return out

    def _after_space(self, words: list[str]) -> list[bytes]:
        return self.whole([" " + word for word in words])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of each."""
        words = pc.split_pattern(texts.cast(pa.string()), " ")
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        index, offsets = coded.indices.to_numpy(), words.offsets.to_numpy()
        is_plain = pc.match_substring_regex(coded.dictionary, _PLAIN).to_numpy(zero_copy_only=False)
        solid = is_plain.copy()
        for i in np.flatnonzero(~is_plain):
            solid[i] = _SOLID.fullmatch(distinct[i]) is not None
        starts, counts = (offsets - offsets[0])[:-1], np.diff(offsets)
        split = np.logical_and.reduceat(solid[index], starts) & (counts > 1)
        # Words after a space, first words, and texts that are not split.
        later = np.repeat(split, counts)
        later[starts] = False
        times = np.bincount(index[later], minlength=len(distinct))
        used = np.flatnonzero(times)
        firsts, rest = np.flatnonzero(split), np.flatnonzero(~split)
        blobs = self.learn([distinct[i] for i in used], is_plain[used], times[used] > 1)
        blobs += self.whole([distinct[index[i]] for i in starts[firsts]])
        blobs += self.whole([texts[int(i)].as_py() for i in rest])
        place = np.zeros(len(distinct), np.int64)
        place[used] = np.arange(len(used))
        unit = place[index]
        unit[starts[firsts]] = len(used) + np.arange(len(firsts))
        unit[starts[rest]] = len(used) + len(firsts) + np.arange(len(rest))
        keep = later
        keep[starts] = True
        text_of = np.repeat(np.arange(len(texts)), counts)[keep]
        unit = unit[keep]
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        ids = np.frombuffer(b"".join(blobs), "<i4")
        ids = ids[ragged((np.cumsum(sizes) - sizes)[unit], sizes[unit])]
        return ids, np.bincount(text_of, sizes[unit], len(texts)).astype(np.int64)


@lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> Encoder:
    """A worker's encoder: it is loaded once and remembers words over tasks."""
    return Encoder(vocabulary)


def encode(documents: DataFrame, vocabulary: str, end_id: int | None = None) -> DataFrame:
    """``doc_id``, ``ids``, ``n_tokens`` and ``ids_crc32`` of every row; a NULL
    text is empty, and ``end_id`` follows each text if given.

    Ids are packed little-endian integers of 16 bits, or of 32 if the vocabulary
    or the end id needs them; the crc32 is that of 32-bit ones.
    """

    def encoded(encoder: Encoder, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        ids, sizes = encoder(rows.column("text").fill_null(""))
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            sizes += 1
        small = max(encoder.library.get_vocab_size(), end_id or 0) < 1 << 16
        return _ids_batch(rows.column("doc_id"), ids, sizes, "<u2" if small else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, n = _encoder(vocabulary), [], 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            ends = np.cumsum(sizes.astype(np.int64))
            at = 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + TOGETHER - n, "right")))
                held.append(batch.slice(at, to - at))
                n += int(ends[to - 1] - before)
                at = to
                if n >= TOGETHER or at < batch.num_rows:
                    yield encoded(encoder, held)
                    held, n = [], 0
        if held:
            yield encoded(encoder, held)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, ids binary, n_tokens long, ids_crc32 long")


def _ids_batch(doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray, kind: str) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    packed = ids.astype(kind)
    places = (packed.itemsize * offsets).astype(np.int32)
    blobs = [None, pa.py_buffer(places), pa.py_buffer(packed)]
    return pa.RecordBatch.from_arrays(
        [
            doc_ids,
            pa.Array.from_buffers(pa.binary(), len(sizes), blobs),
            pa.array(sizes),
            pa.array(_crcs(ids, offsets), pa.int64()),
        ],
        names=["doc_id", "ids", "n_tokens", "ids_crc32"],
    )


def _crcs(ids: np.ndarray, offsets: np.ndarray) -> list[int]:
    """crc32 of each stretch of ids as little-endian 32-bit integers."""
    ids = np.ascontiguousarray(ids, "<i4")
    return [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _with_starts(rows: DataFrame) -> DataFrame:
    """``start``: tokens of the rows before in the same task, whose rows are
    sorted and come in order; ids as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            sizes = batch.column("n_tokens").to_numpy()
            sums = np.cumsum(sizes) + before
            starts = pa.array(sums - sizes, pa.int64())
            before = int(sums[-1]) if len(sums) else before
            columns = {"part": batch.column("part"), "doc_id": batch.column("doc_id"), "start": starts}
            packed = b"".join(batch.column("ids").to_pylist())
            kind = "<u2" if len(packed) == 2 * sizes.sum() else "<u4"
            ids = np.frombuffer(packed, kind).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            columns |= {"n_tokens": batch.column("n_tokens"), "ids": pa.ListArray.from_arrays(offsets, ids)}
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, "part int, doc_id long, start long, n_tokens long, ids array<int>")


def _parts(tokens: DataFrame) -> DataFrame:
    """Of each part its first and last id, documents, tokens, and the tokens
    before it: sums within groups of parts, then over groups."""
    own = tokens.groupBy("part").agg(
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
        F.count("*").alias("n_docs"),
        F.sum("n_tokens").alias("n_tokens"),
    )
    group = F.floor(F.col("part") / PARTS_TOGETHER).cast("int")
    own = staged(own.withColumn("group", group), "part-sums")
    earlier = W.orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    groups = own.groupBy("group").agg(F.sum("n_tokens").alias("sum"))
    groups = groups.select("group", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("group").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    first = F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return own.join(groups, "group").withColumn("first", first).drop("group", "base")


def write(
    documents: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int | None = None,
    layout: Layout | None = None,
) -> None:
    """Encode all documents and write the dataset to a folder, replacing it.

    Rows that share an id stand by their number of tokens and their crc32; rows
    without an id come first. Rows alike in all of these are dealt over parts by
    a number of their own.
    """
    layout = layout or Layout()
    spark = documents.sparkSession
    rows = staged(encode(documents, vocabulary, end_id), "ids")
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    parts = 1 + total // layout.part_tokens
    order = ["doc_id", "n_tokens", "ids_crc32", "_row"]
    dealt = (
        rows.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .select("part", "doc_id", "n_tokens", "ids")
    )
    _with_starts(dealt).write.mode("overwrite").options(**layout.options()).parquet(f"{path}/tokens")
    stored = _tokens(spark, path).select("part", "doc_id", "n_tokens")
    _parts(stored).write.mode("overwrite").parquet(f"{path}/parts")


def _tokens(spark: SparkSession, path: str) -> DataFrame:
    schema = "part int, doc_id long, start long, n_tokens long, ids array<int>"
    return spark.read.schema(schema).parquet(f"{path}/tokens")


def parts(spark: SparkSession, path: str) -> DataFrame:
    schema = "part int, first_doc long, last_doc long, n_docs long, n_tokens long, first long"
    return spark.read.schema(schema).parquet(f"{path}/parts")


def read(spark: SparkSession, path: str, condition: Column | None = None) -> DataFrame:
    """``doc_id``, ``start`` in the whole stream, ``n_tokens`` and ``ids`` of the
    rows with the condition, which may name part, doc_id, n_tokens and start
    within the part; columns that are not used are not read."""
    rows = _tokens(spark, path)
    if condition is not None:
        rows = rows.filter(condition)
    firsts = parts(spark, path).select("part", "first")
    start = (F.col("first") + F.col("start")).alias("start")
    return rows.join(firsts, "part").select("doc_id", start, "n_tokens", "ids")


def stretch(spark: SparkSession, path: str, start: int, end: int) -> DataFrame:
    """Tokens ``start`` to ``end`` of the whole stream: ``doc_id``, ``start`` of
    the first token that is wanted, and ``ids``. Reads the parts, row groups and
    pages that hold them; the parts are looked up in the small table first."""
    within = parts(spark, path).filter((F.col("first") < end) & (F.col("first") + F.col("n_tokens") > start))
    bounds = within.agg(F.min("part"), F.max("part")).first()
    if bounds[0] is None or start >= end:
        bounds = (0, -1)
    rows = read(spark, path, F.col("part").between(*bounds))
    rows = rows.filter((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > start))
    skipped = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    wanted = F.least(F.col("n_tokens"), F.lit(end) - F.col("start")) - skipped
    ids = F.slice("ids", (skipped + 1).cast("int"), wanted.cast("int"))
    return rows.select("doc_id", (F.col("start") + skipped).alias("start"), ids.alias("ids"))


def checked(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` as counted in the list, and the crc32
    of the ids as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy()
            crcs = _crcs(lists.values.to_numpy(zero_copy_only=False), offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("start"),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.select("doc_id", "start", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def digests(documents: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """The documents' ids written to files in the shared folder, read back and
    told by place, count and crc32."""
    spark = documents.sparkSession
    path = work_folder(spark, "token-files")
    write(documents, path, vocabulary, end_id)
    return checked(read(spark, path))
