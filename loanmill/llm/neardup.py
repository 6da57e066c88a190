"""Near-duplicate documents by one-permutation MinHash.

A document's distinct shingles are hashed once; the hash picks a bin and the
smallest hash of each bin is the signature. Empty bins copy from bins that a
hash of bin and attempt picks (optimal densification). Four bins make a band,
and there are as many bands as leave a pair at the threshold unmet with a
chance of ``MISSED`` at most.

Documents with the same shingles are one class from the start. Within a bucket
of a band only star-shaped pairs are made: every class with one center. Pairs
are confirmed on their full sets, and buckets whose classes are then all in one
component are done. The others get some more stars, around classes picked by
hash. What is still apart after that is told by what each class has beyond the
bucket's hub, a class with many links: two classes that are linked and not both
close to the hub share a shingle that the hub has not (``_rest``). So copies cost
a few pairs each, also where many of them are unlike each other, and no link
between different texts that share a bucket is lost.

Components are found by large-star and small-star rounds over tables. Nothing
of the documents or links reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.llm.common import (
    FOLDED,
    ids_and_texts,
    mix,
    prefix_sums,
    staged,
    stretch_hashes,
    text_blocks,
    word_hashes,
    word_spans,
)

BAND = 4
#: Centers that a bucket gets whose first star has left it apart.
STARS = 8
MISSED = 1e-5


@dataclass(frozen=True)
class Likeness:
    """Shingles of ``words`` words; linked if 100 * intersection >= ``percent``
    * union of the two sets."""

    words: int = 5
    percent: int = 80

    @property
    def bands(self) -> int:
        met = (self.percent / 100) ** BAND
        return max(1, math.ceil(math.log(MISSED) / math.log(1 - met))) if met < 1 else 1

    @property
    def bins(self) -> int:
        return BAND * self.bands

    @property
    def least_agreement(self) -> int:
        """Equal bins that a linked pair has but for six standard deviations."""
        share = self.percent / 100
        spread = math.sqrt(self.bins * share * (1 - share))
        return max(1, math.floor(self.bins * share - 6 * spread))


def shingle_sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of each text of a batch. A text of
    fewer words has one shingle of them all; a text without words none."""
    for lo, hi, data, offs in text_blocks(batch):
        begins, ends, bounds = word_spans(data, offs)
        sums = prefix_sums(word_hashes(data, begins, ends, FOLDED))
        at = np.arange(max(len(begins) - words + 1, 0))
        hashes = stretch_hashes(sums, at, at + words)
        for row in range(lo, hi):
            a, b = bounds[row - lo], bounds[row - lo + 1]
            if b - a >= words:
                yield row, np.unique(hashes[a : b - words + 1])
            elif b > a:
                yield row, stretch_hashes(sums, np.array([a]), np.array([b]))
            else:
                yield row, hashes[:0]


def densified(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Signatures whose empty bins have copied from others. Rows have a filled
    bin each; the bins tried are the same for every row."""
    rows, bins = np.nonzero(~filled)
    n_bins = np.uint64(values.shape[1])
    out, attempt = values.copy(), 0
    while len(rows):
        source = mix((bins + attempt * values.shape[1] + 1).astype(np.uint64)) % n_bins
        source = source.astype(np.int64)
        found = filled[rows, source]
        out[rows[found], bins[found]] = values[rows[found], source[found]]
        rows, bins, attempt = rows[~found], bins[~found], attempt + 1
    return out


def signatures(documents: DataFrame, like: Likeness) -> DataFrame:
    """Per document: ``n_shingles``, two sums over its set as ``set_a`` and
    ``set_b``, and the signature ``bins`` (NULL without shingles)."""
    n_bins = like.bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sizes = np.zeros(n, np.int64)
            sums = np.zeros((2, n), np.uint64)
            values, filled = np.zeros((n, n_bins), np.uint32), np.zeros((n, n_bins), bool)
            for row, hashes in shingle_sets(batch, like.words):
                sizes[row] = len(hashes)
                if not len(hashes):
                    continue
                sums[0, row] = hashes.sum(dtype=np.uint64)
                sums[1, row] = mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                bins = ((hashes >> np.uint64(32)) * np.uint64(n_bins) >> np.uint64(32)).astype(int)
                first = np.flatnonzero(np.diff(bins, prepend=-1))
                values[row, bins[first]] = hashes[first].astype(np.uint32)
                filled[row, bins[first]] = True
            some = np.flatnonzero(sizes)
            dense = densified(values[some], filled[some]).view(np.int32)
            offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, n_bins, 0))])
            lists = pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)), pa.array(dense.ravel(), pa.int32())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    lists,
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bins"],
            )

    return documents.mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, bins array<int>"
    )


def sets(documents: DataFrame, like: Likeness) -> DataFrame:
    """``doc_id`` and ``shingles``, the whole set as sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts = zip(*shingle_sets(batch, like.words), strict=True) if batch.num_rows else ((), ())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
            flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
            ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([ids, lists], names=["doc_id", "shingles"])

    return documents.mapInArrow(run, "doc_id long, shingles array<long>")


def _linked(common: Column, n_a: Column, n_b: Column, like: Likeness) -> Column:
    return 100 * common >= like.percent * (n_a + n_b - common)


def _similar(n_a: str, n_b: str, like: Likeness) -> Column:
    """Whether the sizes and the signatures bins_a and bins_b allow a link."""
    equal = F.zip_with("bins_a", "bins_b", lambda x, y: (x == y).cast("int"))
    agreement = F.aggregate(equal, F.lit(0), lambda total, x: total + x)
    smaller = F.least(F.col(n_a), F.col(n_b))
    return _linked(smaller, F.col(n_a), F.col(n_b), like) & (agreement >= like.least_agreement)


def _confirmed(pairs: DataFrame, classes: DataFrame, documents: DataFrame, like: Likeness) -> DataFrame:
    """Those of the pairs (a, b) that are links, by size, signature and sets."""
    side = {
        x: classes.select(
            F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("bins").alias(f"bins_{x}")
        )
        for x in "ab"
    }
    near = staged(
        pairs.join(side["a"], "a")
        .join(side["b"], "b")
        .filter(_similar("n_a", "n_b", like))
        .select("a", "b", "n_a", "n_b"),
        "near",
    )
    wanted = near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    full = sets(documents.join(wanted, "doc_id", "left_semi"), like)
    return (
        near.join(full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
        .filter(
            _linked(F.size(F.array_intersect("set_a", "set_b")), F.col("n_a"), F.col("n_b"), like)
        )
        .select("a", "b")
    )


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that links lead to.

    Rounds of large-star and small-star; each writes its links, which get no
    more numerous, until they do not change.
    """
    links = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    links = staged(links.filter("node <> root").distinct(), "links")
    mark = _fingerprint(links)
    while True:
        both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        large = (
            both.join(least, "node")
            .filter("root > node")
            .select(F.col("root").alias("node"), F.col("least").alias("root"))
            .distinct()
        )
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        joined = large.join(least, "node")
        small = joined.filter("root <> least").select(
            F.col("root").alias("node"), F.col("least").alias("root")
        )
        links = staged(
            small.unionByName(least.select("node", F.col("least").alias("root"))).distinct(), "links"
        )
        before, mark = mark, _fingerprint(links)
        if mark == before:
            return links


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
        ).first()
    )


def _open_buckets(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Members, with their component, of the buckets that hold several. After the
    first star, two classes that share a bucket with no third have met."""
    if roots is not None:
        members = members.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        members = members.withColumn("root", F.coalesce("root", "doc_id"))
    else:
        members = members.withColumn("root", F.col("doc_id"))
    ends = members.groupBy("band").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("total")
    )
    least = 2 if roots is None else 3
    return members.join(ends.filter(f"low <> high and total >= {least}").select("band"), "band")


def _any_centers(open_: DataFrame) -> DataFrame:
    """STARS classes of each bucket, by hashes of their ids."""
    picks = [
        F.struct(
            F.min_by("doc_id", F.xxhash64("doc_id", F.lit(i))).alias("center"),
            F.min_by("root", F.xxhash64("doc_id", F.lit(i))).alias("center_root"),
        )
        for i in range(STARS)
    ]
    picked = open_.groupBy("band").agg(F.array_distinct(F.array(*picks)).alias("picked"))
    return picked.select("band", F.inline("picked"))


def _star(open_: DataFrame, center: DataFrame) -> DataFrame:
    """Pairs of every member with its bucket's center in another component."""
    pairs = open_.join(center, "band").filter("root <> center_root")
    return pairs.select(
        F.least("doc_id", "center").alias("a"), F.greatest("doc_id", "center").alias("b")
    ).distinct()


def _hubs(open_: DataFrame, links: DataFrame) -> DataFrame:
    """A ``hub`` for each bucket: the class with most links so far that its members
    meet in any bucket, by a vote of the members. It need not be in this one."""
    ends = links.select(F.explode(F.array("a", "b")).alias("doc_id"))
    known = open_.join(ends.groupBy("doc_id").agg(F.count("*").alias("degree")), "doc_id", "left")
    ranked = F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "doc_id")
    own = known.groupBy("band").agg(F.max(ranked).alias("best"))
    best = open_.join(own, "band").groupBy("doc_id").agg(F.max("best").alias("best"))
    votes = open_.join(best, "doc_id").groupBy("band", "best").agg(F.count("*").alias("votes"))
    hub = F.max_by(F.col("best.doc_id"), F.struct("votes", "best"))
    return votes.groupBy("band").agg(hub.alias("hub"))


def _beyond(open_: DataFrame, links: DataFrame, documents: DataFrame, like: Likeness) -> DataFrame:
    """Members of open buckets by their hub: the size ``n`` of their set, how much of
    it is ``inside`` the hub's, and ``firsts``, the first of the other shingles in
    the order of all, as many as reach one that a linked class has too.

    Linked sets have ``percent`` of the larger one in common, so of ``n`` at least.
    What of that is not inside is beyond: if k shingles beyond the hub are common,
    the first of them has k - 1 others behind it in either set.
    """
    met = open_.join(_hubs(open_, links), "band").select("hub", "doc_id", "root")
    hubs = met.select(F.col("hub").alias("doc_id")).distinct()
    itself = open_.join(hubs, "doc_id").select(F.col("doc_id").alias("hub"), "doc_id", "root")
    met = staged(met.unionByName(itself).distinct(), "met")
    wanted = met.select(F.explode(F.array("hub", "doc_id")).alias("doc_id")).distinct()
    full = sets(documents.join(wanted, "doc_id", "left_semi"), like)
    least = F.greatest(F.lit(1), F.ceil((like.percent * F.col("n") - 100 * F.col("inside")) / 100))
    length = F.greatest(F.lit(0), F.size("beyond") - least + 1).cast("int")
    rows = (
        met.join(full, "doc_id")
        .join(full.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("core")), "hub")
        # Rows that share an id may give a hub several sets: each is a hub.
        .select(
            F.xxhash64("hub", "core").alias("hub"),
            "doc_id",
            "root",
            F.size("shingles").alias("n"),
            F.array_except("shingles", "core").alias("beyond"),
        )
        .withColumn("inside", F.col("n") - F.size("beyond"))
    )
    return rows.select("hub", "doc_id", "root", "n", "inside", F.slice("beyond", F.lit(1), length).alias("firsts"))


def _several(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of the keys that classes of several components have."""
    ends = rows.groupBy(*keys).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rows.join(ends.filter("low <> high").select(*keys), list(keys))


def _pairs(rows: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Pairs (a, b) of the classes that meet in the keys, of two components, whose
    sizes allow a link."""
    sides = [rows.select(*keys, *[F.col(c).alias(f"{c}_{x}") for c in rows.columns if c not in keys]) for x in "ab"]
    apart = (F.col("doc_id_a") < F.col("doc_id_b")) & (F.col("root_a") != F.col("root_b"))
    pairs = sides[0].join(sides[1], keys).filter(apart & condition)
    return pairs.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))


def _rest(beyond: DataFrame, like: Likeness) -> DataFrame:
    """Pairs of classes of one hub and two components among which are all links.

    Of a linked pair at least percent * (n_a + n_b) / (100 + percent) shingles are
    common. Either all of these may be inside the hub, so both have as many there;
    or one is beyond it, and the pair meets in the first such one. Members that
    the hub is linked with are of its component, and one that is not linked with it
    can be close only to a smaller one: hardly any pairs are of the first kind.
    """
    inside, n, share = F.col("inside"), F.col("n"), like.percent
    close = beyond.drop("firsts").filter(100 * inside >= share * n)
    smallest = close.groupBy("hub").agg(F.min("n").alias("smallest"))
    close = close.join(smallest, "hub").filter((100 + share) * inside >= share * (n + F.col("smallest")))
    both = (100 + share) * F.least("inside_a", "inside_b") >= share * (F.col("n_a") + F.col("n_b"))
    near_hub = _pairs(_several(close.drop("smallest"), "hub"), ["hub"], both)
    shared = beyond.select("hub", "doc_id", "root", "n", F.explode("firsts").alias("shingle"))
    sizes = 100 * F.least("n_a", "n_b") >= share * F.greatest("n_a", "n_b")
    far = _pairs(_several(shared, "hub", "shingle"), ["hub", "shingle"], sizes)
    return near_hub.unionByName(far).distinct()


def near_duplicates(documents: DataFrame, like: Likeness | None = None, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the
    smallest id that links lead to, its own included) and ``kept``, whether
    that is its own.

    Words are whatever lies between white space, A-Z in lower case. NULL and
    empty texts have no shingles and no links. Rows that share an id are one
    document. A row without an id has no links, no component and is kept.
    """
    like = like or Likeness()
    documents = ids_and_texts(documents, text)
    signed = staged(signatures(documents, like), "signatures")
    same = ["set_a", "set_b", "n_shingles"]
    named = signed.filter("doc_id is not null and n_shingles > 0")
    first = named.groupBy(*same).agg(F.min("doc_id").alias("class_id"))
    members = staged(
        named.select("doc_id", *same).join(first, same).select("doc_id", "class_id"), "classes"
    )
    heads = members.filter("doc_id = class_id").select("doc_id").distinct()
    classes = staged(
        named.select("doc_id", "n_shingles", "bins").join(heads, "doc_id", "left_semi"), "heads"
    )
    parts = [
        F.xxhash64(F.lit(i), *[F.col("bins")[BAND * i + j] for j in range(BAND)])
        for i in range(like.bands)
    ]
    banded = classes.select("doc_id", F.explode(F.array(*parts)).alias("band"))
    crowded = banded.groupBy("band").count().filter("count > 1").select("band")
    buckets = staged(banded.join(crowded, "band"), "buckets")
    heads_only = documents.join(
        buckets.select("doc_id").distinct(), "doc_id", "left_semi"
    )

    # First star: the smallest class of each bucket is its center.
    open_ = _open_buckets(buckets, None)
    center = open_.groupBy("band").agg(F.min("doc_id").alias("center"))
    found = [staged(_confirmed(_star(open_, center.withColumn("center_root", F.col("center"))), classes, heads_only, like), "links")]
    roots = components(found[0])

    # More stars in the buckets that are still apart, around any of their classes.
    open_ = staged(_open_buckets(buckets, roots), "open")
    found.append(staged(_confirmed(_star(open_, _any_centers(open_)), classes, heads_only, like), "links"))
    roots = components(reduce(DataFrame.unionByName, found))

    # What no star has joined meets by what it has beyond the hub of its bucket.
    open_ = staged(_open_buckets(open_.drop("root"), roots), "open")
    links = reduce(DataFrame.unionByName, found)
    rest = _rest(staged(_beyond(open_, links, heads_only, like), "beyond"), like)
    found.append(staged(_confirmed(rest, classes, heads_only, like), "links"))
    roots = components(reduce(DataFrame.unionByName, found))

    by_class = members.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
    by_class = by_class.select(
        "doc_id", F.coalesce("root", "class_id").alias("component_id")
    ).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return (
        signed.select("doc_id", "n_shingles")
        .join(by_class, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def kept_documents(documents: DataFrame, like: Likeness | None = None) -> DataFrame:
    """One document of each component, all columns as they are."""
    kept = near_duplicates(documents, like).filter("kept")
    ids = kept.select("doc_id").distinct()
    return documents.join(ids, documents["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
