"""Language of documents, word by word.

A word is a run of letters. Its script narrows the languages to those that were
seen in that script; each of them scores the word by its letter pairs and
triples; and a Viterbi pass over the words of a text, with a penalty for every
change of language, labels spans. A text's language is the one with the most
letters.

Counts of pairs and triples are gathered over all training documents in tables
of a fixed number of slots per language and added up as tables, so what comes
to the driver is the model and does not grow with the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.llm.common import text_blocks

SLOTS = 1 << 15
#: Pieces that a table of counts is sent in.
PARTS = 16
#: Labels beyond this are no languages.
MOST_LANGUAGES = 2000
#: Texts whose words go through the Viterbi steps together, in bytes.
TOGETHER = 12 << 20
SCRIPTS = (
    "Latin Greek Cyrillic Armenian Hebrew Arabic Devanagari Bengali Gurmukhi Gujarati Tamil "
    "Telugu Kannada Malayalam Sinhala Thai Lao Tibetan Myanmar Georgian Ethiopic Khmer Mongolian "
    "Hiragana Katakana Hangul Han"
).split()


class Letters:
    """Script and lower case of every code point; script 0 is no letter."""

    _made: Letters | None = None

    def __init__(self) -> None:
        points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        text = "".join(map(chr, points))
        at = np.array(points)
        self.script = np.zeros(0x110000, np.uint8)
        for number, what in enumerate([r"\p{L}", *[rf"\p{{Script={s}}}" for s in SCRIPTS]], 1):
            for m in regex.finditer(rf"[{what}&&\p{{L}}]+", text, regex.V1):
                self.script[at[m.start() : m.end()]] = number
        self.lower = np.arange(0x110000, dtype=np.uint32)
        for m in regex.finditer(r"\p{Lu}", text):
            low = m[0].lower()
            if len(low) == 1:
                self.lower[ord(m[0])] = ord(low)

    @classmethod
    def get(cls) -> Letters:
        cls._made = cls._made or cls()
        return cls._made


@dataclass
class Words:
    """Words of several texts: the text, first letter, letters and script of
    each; the letters' places in the texts and their slots."""

    text: np.ndarray
    first: np.ndarray
    size: np.ndarray
    script: np.ndarray
    slots: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offs: np.ndarray) -> Words:
        letters = Letters.get()
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        begins_point = (data & 0xC0) != 0x80
        edges = np.concatenate([[0], np.cumsum(begins_point)])[offs]
        script = letters.script[points]
        is_letter = script > 0
        edge = np.zeros(len(points) + 1, bool)
        edge[edges] = True
        before = edge[:-1].copy()
        before[1:] |= ~is_letter[:-1]
        # Neighbours of a letter; zero beyond the word.
        low = np.where(is_letter, letters.lower[points], 0).astype(np.uint64)
        ahead, behind = np.zeros_like(low), np.zeros_like(low)
        behind[1:] = low[:-1]
        behind[edge[:-1]] = 0
        ahead[:-1] = low[1:]
        ahead[edge[1:]] = 0
        at = np.flatnonzero(is_letter)
        pair = behind[at] << np.uint64(21) | low[at]
        triple = pair << np.uint64(21) | ahead[at] | np.uint64(1) << np.uint64(63)
        slots = np.stack([cls._slot(pair), SLOTS + cls._slot(triple)], 1)
        first = np.flatnonzero(before[at])
        size = np.diff(np.append(first, len(at)))
        start = at[first]
        text = np.searchsorted(edges, start, "right") - 1
        return cls(text, first, size, script[start], slots, start - edges[text])

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        spread = (key ^ key >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - 15)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """``scores`` by slot and language, ``allowed`` by script and language."""

    languages: list[str]
    scores: np.ndarray
    allowed: np.ndarray
    penalty: float = field(default=8.0)

    def word_scores(self, words: Words) -> np.ndarray:
        """One row per word; languages that its script rules out are far below."""
        each = self.scores[words.slots[:, 0]] + self.scores[words.slots[:, 1]]
        out = np.add.reduceat(each, words.first, axis=0) if len(words.first) else each[:0]
        return np.where(self.allowed[words.script], out, np.float32(-1e6))


def labels_of(scores: np.ndarray, text: np.ndarray, n_texts: int, penalty: float) -> np.ndarray:
    """The best sequence of languages of each text's words. All texts take their
    steps together, the long ones last to leave."""
    counts = np.bincount(text, minlength=n_texts)
    by_size = np.argsort(-counts, kind="stable")
    rank = np.empty(n_texts, np.int64)
    rank[by_size] = np.arange(n_texts)
    step = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    lanes = np.bincount(step) if len(step) else np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.cumsum(lanes)])
    place = begin[step] + rank[text]
    ordered = np.empty_like(scores)
    ordered[place] = scores
    stays = np.ones(scores.shape, bool)
    best_before = np.zeros(len(text), np.int16)
    value = ordered[: lanes[0]].copy() if len(lanes) else ordered
    ends = np.zeros(n_texts, np.int64)
    for t in range(1, len(lanes)):
        n = lanes[t]
        ends[n : len(value)] = value[n:].argmax(1)
        value = value[:n]
        a, b = begin[t], begin[t + 1]
        best = value.argmax(1)
        switched = value[np.arange(n), best] - penalty
        stay = value >= switched[:, None]
        value = np.where(stay, value, switched[:, None]) + ordered[a:b]
        value -= value.max(1)[:, None]
        stays[a:b], best_before[a:b] = stay, best
    if len(lanes):
        ends[: len(value)] = value.argmax(1)
    labels = np.zeros(len(text), np.int16)
    state = ends[: lanes[-1]] if len(lanes) else ends[:0]
    for t in range(len(lanes) - 1, -1, -1):
        a, b = begin[t], begin[t + 1]
        if len(state) < lanes[t]:
            state = np.concatenate([state, ends[len(state) : lanes[t]]])
        labels[a:b] = state
        if t:
            stay = stays[np.arange(a, b), state]
            state = np.where(stay, state, best_before[a:b])
    return labels[place]


def _counts(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Tables of counts of each task, in parts: slots and scripts by language."""
    number = {name: i for i, name in enumerate(languages)}
    width = 2 * SLOTS + len(SCRIPTS) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, len(languages)), np.int64)
        for batch in batches:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for lo, _, data, offs in text_blocks(batch):
                words = Words.of(data, offs)
                of_word = lang[lo + words.text]
                of_letter = np.repeat(of_word, words.size)
                for which, by in (
                    (words.slots[:, 0], of_letter),
                    (words.slots[:, 1], of_letter),
                    (2 * SLOTS + words.script.astype(np.int64), of_word),
                ):
                    flat = np.bincount(which * len(languages) + by, minlength=total.size)
                    total += flat.reshape(total.shape)
        salt = TaskContext.get().partitionId() % 64
        blobs = [x.astype("<i8").tobytes() for x in np.array_split(total.ravel(), PARTS)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(PARTS), pa.int32()),
                pa.array([salt] * PARTS, pa.int32()),
                pa.array(blobs, pa.binary()),
            ],
            names=["part", "salt", "counts"],
        )

    return rows.mapInArrow(run, "part int, salt int, counts binary")


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
            counts = np.frombuffer(blob.as_py(), "<i8")
            sums[part] = sums[part] + counts if part in sums else counts
    if sums:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(sums.keys(), pa.int32()),
                pa.array([0] * len(sums), pa.int32()),
                pa.array([x.tobytes() for x in sums.values()], pa.binary()),
            ],
            names=["part", "salt", "counts"],
        )


def train(documents: DataFrame, training: Column, penalty: float = 8.0) -> Model:
    """Counts over all documents for which ``training`` holds and whose lang and
    text are not NULL. A language belongs to a script if one in a thousand of
    its words is written in it; a script that was never seen excludes none."""
    rows = documents.filter(training).select("text", "lang").filter("lang is not null and text is not null")
    names = rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()
    languages = sorted(r.lang for r in names)
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels")
    if not languages:
        return Model([], np.zeros((2 * SLOTS, 0), np.float32), np.zeros((len(SCRIPTS) + 2, 0), bool))
    schema = "part int, salt int, counts binary"
    tables = _counts(rows, languages)
    for keys in (("part", "salt"), ("part",)):
        tables = tables.repartition(*keys).mapInArrow(_added, schema)
    blobs = {r.part: r.counts for r in tables.collect()}
    flat = np.concatenate([np.frombuffer(blobs[p], "<i8") for p in range(PARTS)])
    counts = flat.reshape(-1, len(languages)).astype(np.float64)
    scores = []
    for kind in (counts[:SLOTS], counts[SLOTS : 2 * SLOTS]):
        scores.append(np.log((kind + 0.5) / (kind.sum(0) + 0.5 * SLOTS)))
    scripts = counts[2 * SLOTS :]
    allowed = scripts >= np.maximum(scripts.sum(0) / 1000, 1)
    allowed |= ~allowed.any(1)[:, None]
    return Model(languages, np.concatenate(scores).astype(np.float32), allowed, penalty)


def identify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``lang_spans``.

    ``lang_pred`` is the language with the most letters (of ties the first by
    name), ``score`` its share of the letters, and ``lang_spans`` tells the
    spans in code points as ``lang:start:end``, joined by commas. A NULL text
    or one without letters is ``und`` with score 0 and no spans, as is any text
    if nothing was learned. Columns named like these are replaced.
    """
    names = ["lang_pred", "score", "lang_spans"]
    keep = [c for c in documents.columns if c not in names]
    schema = documents.select(*keep).schema
    schema = schema.add("lang_pred", "string").add("score", "double").add("lang_spans", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, _, _ in text_blocks(batch, text, TOGETHER):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *_labelled(part, model, text)],
                    names=[*batch.schema.names, *names],
                )

    return documents.select(*keep).mapInArrow(run, schema)


def _labelled(batch: pa.RecordBatch, model: Model, column: str) -> list[pa.Array]:
    n = batch.num_rows
    predicted, share, spans = ["und"] * n, [0.0] * n, [""] * n
    if model.languages:
        scores, texts, sizes, starts = [], [], [], []
        for lo, _, data, offs in text_blocks(batch, column):
            words = Words.of(data, offs)
            scores.append(model.word_scores(words))
            texts.append(lo + words.text)
            sizes.append(words.size)
            starts.append(words.start)
        text, size, start = map(np.concatenate, (texts, sizes, starts))
        label = labels_of(np.concatenate(scores), text, n, model.penalty)
        width = len(model.languages)
        letters = np.bincount(text * width + label, size, n * width).reshape(n, width)
        best = letters.argmax(1)
        total = letters.sum(1)
        for i in np.flatnonzero(total):
            predicted[i] = model.languages[best[i]]
            share[i] = float(letters[i, best[i]] / total[i])
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (label[1:] != label[:-1])
        first = np.flatnonzero(new)
        last = np.append(first, len(text))[1:] - 1
        found: dict[int, list[str]] = {}
        for i, a, b, lang in zip(
            text[first].tolist(),
            start[first].tolist(),
            (start[last] + size[last]).tolist(),
            label[first].tolist(),
            strict=True,
        ):
            found.setdefault(i, []).append(f"{model.languages[lang]}:{a}:{b}")
        for i, parts in found.items():
            spans[i] = ",".join(parts)
    return [pa.array(predicted), pa.array(share, pa.float64()), pa.array(spans)]
