"""Secrets in documents: rules, and a character network for what they miss.

Three rules find base spans. Every other run of 16 or more key characters that
holds a digit is a candidate; a small convolutional network in numpy reads all
its characters with the text around it and gives a calibrated chance that it is
a secret. It is trained on labelled findings: what the rules found against
candidates that no rule touches, with the surroundings hidden at random, so that
it learns the keys and not only the words before them. Its threshold is the
highest one that keeps a required recall on findings it was not trained on.

Training takes every distinct window of every document: a quarter is held back
for calibration and threshold, which are exact over it, and the rest is dealt
over shards. In each round all shards train on from the same network, and the
next round begins with the mean of theirs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.llm.common import staged, text_blocks, word_spans

#: The rules, in the order of their kinds.
ASSIGN = re.compile(
    rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "network")

LEAST_CANDIDATE = 16
#: Characters before, within and after a candidate that a window holds. Longer
#: candidates are several windows, half of one apart.
BEFORE, WITHIN, AFTER = 16, 32, 8
WINDOW = BEFORE + WITHIN + AFTER


def _not(characters: bytes) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(characters)] = False
    return table


_DIGITS = b"0123456789"
_LETTERS = b"abcdefghijklmnopqrstuvwxyz"
NOT_HEX = _not(_DIGITS + b"abcdef")
NOT_KEY = _not(_DIGITS + _LETTERS + _LETTERS.upper() + b"+/_.=-")


@dataclass(frozen=True)
class Training:
    """Windows of a shard, about; the recall that the threshold must keep; size
    and rounds of the network."""

    shard: int = 4500
    recall: float = 0.98
    channels: int = 16
    width: int = 5
    embedding: int = 8
    epochs: int = 6
    seed: int = 3


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """Start, kind and end, in bytes, of what the two rules over words find."""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(raw) if len(m[2]) >= LEAST_ASSIGN
    ]
    if b"AKIA" in raw:
        found += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if len(m[0]) >= LEAST_ACCESS
        ]
    return found


def scan(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, list, list]]:
    """Texts with anything in them: number, base spans, and the start and end of
    every candidate that no base span touches, all in bytes of the text."""
    hex_starts, hex_ends, _ = word_spans(data, offs, NOT_HEX)
    long_ = np.flatnonzero(hex_ends - hex_starts >= LEAST_HEX)
    hex_starts, hex_ends = hex_starts[long_], hex_ends[long_]
    hex_of = np.searchsorted(hex_starts, offs)
    starts, ends, _ = word_spans(data, offs, NOT_KEY)
    long_ = np.flatnonzero(ends - starts >= LEAST_CANDIDATE)
    starts, ends = starts[long_], ends[long_]
    digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57), dtype=np.int64)])
    some = digits[ends] > digits[starts]
    starts, ends = starts[some], ends[some]
    of = np.searchsorted(starts, offs)
    raw = data.tobytes()
    for text in range(len(offs) - 1):
        begin, end = int(offs[text]), int(offs[text + 1])
        spans = base_spans(raw[begin:end])
        a, b = hex_of[text], hex_of[text + 1]
        spans += [
            (int(x) - begin, 2, int(y) - begin)
            for x, y in zip(hex_starts[a:b], hex_ends[a:b], strict=True)
        ]
        a, b = of[text], of[text + 1]
        others = [
            (int(x) - begin, int(y) - begin)
            for x, y in zip(starts[a:b], ends[a:b], strict=True)
            if not any(s < y - begin and x - begin < e for s, _, e in spans)
        ]
        if spans or others:
            yield text, sorted(spans), others


def windows(raw: bytes, start: int, end: int) -> list[bytes]:
    """Windows that together hold all of the span with its surroundings."""
    out = []
    for at in range(start, max(start + 1, end - WITHIN // 2), WITHIN // 2):
        stop = min(at + WITHIN, end)
        before = raw[max(0, at - BEFORE) : at].rjust(BEFORE, b"\0")
        out.append((before + raw[at:stop] + raw[stop : stop + AFTER]).ljust(WINDOW, b"\0"))
    return out


def classes(rows: list[bytes]) -> np.ndarray:
    """Bytes as 64 classes: printable ones by pairs of rows of the code table,
    lower-case letters, capitals and digits each their own."""
    table = np.zeros(256, np.int64)
    table[48:58] = np.arange(1, 11)
    table[97:123] = np.arange(11, 37)
    table[65:91] = 37
    for i, sign in enumerate(b" \"'=:+/_.-,;(){}[]<>@#$%&*!?\n"):
        table[sign] = 38 + min(i, 20)
    table[128:] = 59
    table[0] = 60
    return table[np.frombuffer(b"".join(rows), np.uint8).reshape(-1, WINDOW)]


class Network:
    """Embedding, one convolution, greatest and mean value over places, logit."""

    NAMES = ("embed", "filters", "bias", "out", "shift")

    def __init__(self, sample: Training) -> None:
        random = np.random.default_rng(sample.seed)
        self.width = sample.width
        self.embed = random.normal(0, 0.5, (64, sample.embedding)).astype(np.float32)
        spread = 1 / np.sqrt(sample.embedding * sample.width)
        self.filters = random.normal(0, spread, (sample.width * sample.embedding, sample.channels)).astype(np.float32)
        self.bias = np.zeros(sample.channels, np.float32)
        self.out = random.normal(0, 0.1, 2 * sample.channels).astype(np.float32)
        self.shift = np.zeros(1, np.float32)
        self.moments = tuple({n: np.zeros_like(getattr(self, n)) for n in self.NAMES} for _ in range(2))
        #: Slope and intercept of the calibration, and the threshold.
        self.slope, self.intercept, self.threshold = 1.0, 0.0, 1.1

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        places = WINDOW - self.width + 1
        look = np.arange(places)[:, None] + np.arange(self.width)
        columns = self.embed[x][:, look].reshape(len(x), places, -1)
        hidden = np.maximum(columns @ self.filters + self.bias, 0)
        top = hidden.argmax(1)
        pooled = np.concatenate([hidden.max(1), hidden.mean(1)], 1)
        return columns, hidden, top, pooled, pooled @ self.out + self.shift

    def logits(self, rows: list[bytes]) -> np.ndarray:
        parts = [
            self._forward(classes(rows[at : at + 2000]))[-1] for at in range(0, len(rows), 2000)
        ]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def chances(self, rows: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(rows) + self.intercept, -30, 30)))

    def state(self) -> np.ndarray:
        """The weights and Adam's two moments of them."""
        parts = [own[n] for own in (self.__dict__, *self.moments) for n in self.NAMES]
        return np.concatenate([x.ravel() for x in parts]).astype(np.float64)

    def set_state(self, flat: np.ndarray) -> None:
        self.moments, at = ({}, {}), 0
        for own in (self.__dict__, *self.moments):
            for n in self.NAMES:
                shape = getattr(self, n).shape
                size = int(np.prod(shape))
                own[n] = flat[at : at + size].reshape(shape).astype(np.float32)
                at += size

    def train(self, x: np.ndarray, y: np.ndarray, number: int, seed: int) -> None:
        """Round ``number`` over the examples."""
        random = np.random.default_rng([seed, number])
        order = random.permutation(len(x))
        starts = range(0, len(order), 128)
        for t, at in enumerate(starts, 1 + number * len(starts)):
            some = order[at : at + 128]
            rows, want = x[some].copy(), y[some]
            hide = random.random(len(rows)) < 0.5
            rows[np.ix_(hide, np.r_[0:BEFORE])] = 60
            for name, gradient in self._gradients(rows, want).items():
                first, second = (m[name] for m in self.moments)
                first += 0.1 * (gradient - first)
                second += 0.001 * (gradient**2 - second)
                step = first / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
                setattr(self, name, getattr(self, name) - np.float32(0.005) * step)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        columns, hidden, top, pooled, logit = self._forward(x)
        n, places, channels = hidden.shape
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30)))) - y) / n
        to_pooled = error[:, None] * self.out
        to_hidden = np.repeat(to_pooled[:, None, channels:] / places, places, 1)
        at = np.arange(n)[:, None], top, np.arange(channels)[None, :]
        to_hidden[at] += to_pooled[:, :channels]
        to_hidden *= hidden > 0
        to_columns = (to_hidden @ self.filters.T).reshape(n, places, self.width, -1)
        to_embed = np.zeros_like(self.embed)
        for j in range(self.width):
            np.add.at(to_embed, x[:, j : j + places], to_columns[:, :, j])
        return {
            "embed": to_embed,
            "filters": np.einsum("npc,npk->ck", columns, to_hidden),
            "bias": to_hidden.sum((0, 1)),
            "out": pooled.T @ error,
            "shift": error.sum(keepdims=True),
        }

    def calibrate(self, scored: DataFrame, recall: float) -> None:
        """Platt scaling by Newton's steps over all rows of ``scored`` (logit,
        label), then the highest threshold that still finds ``recall`` of the
        findings among them. Only sums and counts reach the driver."""
        x, y = F.col("logit").cast("double"), F.col("label")
        slope, intercept = 1.0, 0.0
        for _ in range(12):
            p = 1 / (1 + F.exp(-F.greatest(F.least(slope * x + intercept, F.lit(30.0)), F.lit(-30.0))))
            w = p * (1 - p)
            terms = ((p - y) * x, p - y, w * x * x, w * x, w)
            g1, g0, h11, h10, h00 = scored.select(*[F.avg(c) for c in terms]).first()
            h11, h00 = h11 + 1e-3, h00 + 1e-3
            both = h11 * h00 - h10 * h10
            step = (h00 * g1 - h10 * g0) / both, (h11 * g0 - h10 * g1) / both
            slope, intercept = slope - float(np.clip(step[0], -1, 1)), intercept - float(np.clip(step[1], -1, 1))
        self.slope, self.intercept = max(slope, 1e-3), intercept
        least = _order_statistic(scored.filter("label = 1"), 1 - recall)
        if least is not None:
            p = self.slope * np.array([least], np.float32) + self.intercept
            self.threshold = float((1 / (1 + np.exp(-np.clip(p, -30, 30))))[0])


def _order_statistic(scored: DataFrame, share: float) -> float | None:
    """The logit at that share of all, from below; exact, by two counts of halves
    of the floats' bits, in their order: at most 65,536 rows each."""
    high, low = F.shiftright("ordered", 16), F.col("ordered").bitwiseAND(65535)

    def at(rows: DataFrame, half: Column, rank: int) -> tuple[int, int]:
        for key, n in sorted(rows.groupBy(half.alias("half")).count().collect()):
            if rank < n:
                return key, rank
            rank -= n
        raise ValueError("rank beyond the rows")

    total = scored.count()
    if not total:
        return None
    top, rank = at(scored, high, int(share * total))
    bottom, _ = at(scored.filter(high == top), low, rank)
    bits = np.array([top << 16 | bottom], np.int64)
    bits = np.where(bits < 0, bits ^ 0x7FFFFFFF, bits).astype(np.int32)
    return float(bits.view(np.float32)[0])


def _examples(documents: DataFrame) -> DataFrame:
    """Windows of findings (label 1) and of other candidates (label 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in text_blocks(batch):
                raw, rows, labels = data.tobytes(), [], []
                for text, spans, others in scan(data, offs):
                    own = raw[offs[text] : offs[text + 1]]
                    found = []
                    for start, kind, end in spans:
                        if kind == 0:  # the key alone
                            start = end - len(ASSIGN.match(own, start)[2])
                        if end - start >= LEAST_CANDIDATE:
                            found.append((start, end))
                    for label, places in ((1, sorted(set(found))), (0, others)):
                        for start, end in places:
                            more = windows(own, start, end)
                            rows += more
                            labels += [label] * len(more)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.binary()), pa.array(labels, pa.int32())],
                    names=["row", "label"],
                )

    return documents.mapInArrow(run, "row binary, label int")


def _scored(examples: DataFrame, network: Network) -> DataFrame:
    """Logit of each window, its label, and the logit's bits as an integer of the
    same order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logits = network.logits(batch.column("row").to_pylist()).astype(np.float32)
            bits = logits.view(np.int32)
            ordered = np.where(bits < 0, bits ^ 0x7FFFFFFF, bits).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(logits), batch.column("label"), pa.array(ordered)],
                names=["logit", "label", "ordered"],
            )

    return examples.select("row", "label").mapInArrow(run, "logit float, label int, ordered int")


#: Weights are added up as integers of this unit: sums in any order are equal.
UNIT = 2.0**-40


def _round(
    used: DataFrame, network: Network, number: int, sample: Training
) -> np.ndarray:
    """Mean, by numbers of examples, of the states that the shards end at."""
    state = network.state()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("row", "ascending"), ("label", "ascending")])
        x = classes(table.column("row").to_pylist())
        y = table.column("label").to_numpy().astype(np.float32)
        own = Network(sample)
        own.set_state(state)
        own.train(x, y, number, sample.seed)
        units = np.rint(own.state() / UNIT * len(y)).astype(np.int64)
        return pa.table({"n": pa.array([len(y)], pa.int64()), "units": pa.array([units], pa.list_(pa.int64()))})

    shards = used.groupBy("shard").applyInArrow(run, "n long, units array<long>")
    sums = shards.select("n", F.posexplode("units")).groupBy("pos").agg(
        F.sum(F.col("col").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    return np.array([float(r.total) / r.n * UNIT for r in sorted(sums.collect(), key=lambda r: r.pos)])


def train(documents: DataFrame, sample: Training | None = None) -> Network:
    """Train on the findings of the rules and the other candidates of all
    documents. With none of the one or the other kind nothing is added to what
    the rules find.
    """
    sample = sample or Training()
    found = _examples(documents.select("text").filter("text is not null")).distinct()
    key = F.xxhash64("row", F.lit(sample.seed))
    examples = staged(found.select("row", "label", key.alias("key")), "examples")
    network = Network(sample)
    counts = dict(tuple(r) for r in examples.groupBy("label").count().collect())
    total = sum(counts.values())
    if total < 8 or len(counts) < 2:
        return network
    # Bits of the key tell what is held back, and the shard of the rest.
    held = F.pmod("key", F.lit(4)) == 0
    shards = 1 + total // sample.shard
    used = examples.filter(~held).withColumn("shard", F.pmod(F.shiftright("key", 2), F.lit(shards)))
    if used.limit(1).count():
        for number in range(sample.epochs):
            network.set_state(_round(used, network, number, sample))
    network.calibrate(staged(_scored(examples.filter(held), network), "logits"), sample.recall)
    return network


def find(documents: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """Add ``n_assign``, ``n_access``, ``n_hex``, ``base_spans`` and ``spans``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then
    kind, joined by commas; ``base_spans`` has those of the rules, ``spans`` also
    those of the network. Base spans are whole matches of their rule. A NULL or
    empty text has none. Columns named like these are replaced.
    """
    names = ["n_assign", "n_access", "n_hex", "base_spans", "spans"]
    keep = [c for c in documents.columns if c not in names]
    schema = documents.select(*keep).schema
    for name in names:
        schema = schema.add(name, "long" if name.startswith("n_") else "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((3, n), np.int64)
            base, every = [""] * n, [""] * n
            for row, own, spans, added in _found(batch, network, text):
                for kind in range(3):
                    counts[kind, row] = sum(s[1] == kind for s in spans)
                base[row] = _written(own, spans)
                every[row] = _written(own, sorted(spans + added)) if added else base[row]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    *[pa.array(c) for c in counts],
                    pa.array(base, pa.string()),
                    pa.array(every, pa.string()),
                ],
                names=[*batch.schema.names, *names],
            )

    return documents.select(*keep).mapInArrow(run, schema)


def _found(
    batch: pa.RecordBatch, network: Network, text: str
) -> Iterator[tuple[int, bytes, list, list]]:
    """Row, bytes, base spans and the network's spans of texts with any."""
    for lo, _, data, offs in text_blocks(batch, text):
        raw, held, rows = data.tobytes(), [], []
        for number, spans, others in scan(data, offs):
            own = raw[offs[number] : offs[number + 1]]
            parts = [windows(own, start, end) for start, end in others]
            held.append((lo + number, own, spans, others, [len(x) for x in parts]))
            rows += [w for x in parts for w in x]
        chances, at = network.chances(rows), 0
        for row, own, spans, others, sizes in held:
            added = []
            for (start, end), size in zip(others, sizes, strict=True):
                if chances[at : at + size].max() >= network.threshold:
                    added.append((start, 3, end))
                at += size
            if spans or added:
                yield row, own, spans, added


def _written(raw: bytes, spans: list[tuple[int, int, int]]) -> str:
    """Spans with offsets in code points instead of bytes."""
    if raw.isascii():
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
    starts = np.frombuffer(raw, np.uint8) & 0xC0 != 0x80
    point = np.concatenate([[0], np.cumsum(starts)])
    return ",".join(f"{KINDS[k]}:{point[s]}:{point[e]}" for s, k, e in spans)


def masked(
    documents: DataFrame, network: Network, text: str = "text", mark: str = "[SECRET]"
) -> DataFrame:
    """Documents with every found span replaced by the mark; overlapping spans
    get one. All other columns, and documents without spans, stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for row, own, spans, added in _found(batch, network, text):
                texts[row] = _masked(own, spans + added, mark.encode()).decode()
            columns = list(batch.columns)
            columns[batch.schema.get_field_index(text)] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return documents.mapInArrow(run, documents.schema)


def _masked(raw: bytes, spans: list[tuple[int, int, int]], mark: bytes) -> bytes:
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [raw[at:start], mark]
        at = max(at, end)
    return b"".join([*out, raw[at:]])


def digests(documents: DataFrame, network: Network) -> DataFrame:
    return find(documents.select("doc_id", "text"), network).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )
