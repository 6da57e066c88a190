"""Quality of documents, learned from positive and unlabelled texts.

Trusted positives are texts labelled good; everything else is unlabelled web
text, bad labels included. The share of good texts in it (the class prior) is
estimated from the scores of a first classifier on held-back halves: above a
threshold that only positives reach, the ratio of unlabelled to positive texts
is the prior. The classifier then minimises the non-negative unbiased risk

    prior * E_p[l(f, 1)] + max(0, E_u[l(f, 0)] - prior * E_p[l(f, 0)])

with the logistic loss, so its output is a probability. Training sees a bounded
sample, its size a parameter; every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.llm.common import EXACT, text_blocks, word_hashes, word_spans

#: Kinds of bytes: letters, capitals, digits, blanks, ends of lines, signs that
#: prose uses or that markup and junk use, other signs, bytes beyond ASCII.
KINDS = np.full(256, 19, np.int64)
KINDS[97:123], KINDS[65:91], KINDS[48:58], KINDS[128:] = 0, 1, 2, 20
for _kind, _signs in enumerate(
    (b" \t", b"\n\r", b".", b",", b"'\"", b"()[]{}<>", b"|", b"!", b"?", b"-", b"_", b"/\\", b":;", b"*", b"#", b"$%&@+=~^"), 3
):
    KINDS[list(_signs)] = _kind
N_KINDS = 21
PAIRS = N_KINDS**2
SHAPES = 4
FEATURES = PAIRS + SHAPES


@dataclass(frozen=True)
class Sample:
    """Most positives and unlabelled texts that training looks at, chosen by a
    hash of the id; steps of gradient descent, texts of each kind in a step, and
    the size of a step."""

    positives: int = 4000
    unlabelled: int = 6000
    steps: int = 2500
    batch: int = 500
    rate: float = 0.1
    decay: float = 1e-6
    seed: int = 11


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row per text: shares of pairs of kinds of neighbouring bytes, and the
    length of the text and of its words, the share of distinct words and that
    of words that repeat the one before."""
    n = len(offs) - 1
    sizes = np.diff(offs)
    row = np.repeat(np.arange(n), sizes)
    kind = KINDS[data]
    inside = row[:-1] == row[1:]
    slot = row[:-1] * PAIRS + kind[:-1] * N_KINDS + kind[1:]
    flat = np.bincount(slot[inside], minlength=n * PAIRS)
    out = np.zeros((n, FEATURES), np.float32)
    out[:, :PAIRS] = np.sqrt(flat.reshape(n, PAIRS) / np.maximum(sizes, 1)[:, None])
    begins, ends, bounds = word_spans(data, offs)
    words = np.maximum(np.diff(bounds), 1)
    hashes = word_hashes(data, begins, ends, EXACT)
    of_word = np.repeat(np.arange(n), np.diff(bounds))
    own = np.sort(of_word.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    distinct = np.bincount((own[new] >> np.uint64(40)).astype(np.int64), minlength=n)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    out[:, PAIRS] = np.log1p(sizes)
    out[:, PAIRS + 1] = np.log1p(sizes / words)
    out[:, PAIRS + 2] = distinct / words
    out[:, PAIRS + 3] = np.sqrt(np.bincount(of_word[same], minlength=n) / words)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _loss(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def fit_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float, sample: Sample) -> np.ndarray:
    """Weights, with the bias last, that minimise the non-negative risk, by
    Adam over small batches. Where the risk of the negatives goes below zero,
    its gradient is turned. The weights of the last half are averaged."""
    random = np.random.default_rng(sample.seed)
    weights, first, second, mean = np.zeros((4, positive.shape[1]), np.float32)
    for t in range(1, sample.steps + 1):
        p = positive[random.integers(0, len(positive), sample.batch)]
        u = unlabelled[random.integers(0, len(unlabelled), sample.batch)]
        f_p, f_u = p @ weights, u @ weights
        good = prior * (p.T @ (_sigmoid(f_p) - 1)) / len(p)
        bad = u.T @ _sigmoid(f_u) / len(u) - prior * (p.T @ _sigmoid(f_p)) / len(p)
        risk = _loss(f_u).mean() - prior * _loss(f_p).mean()
        gradient = (good + bad if risk >= 0 else -bad) + sample.decay * weights
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient**2 - second)
        step = first / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        weights = (weights - sample.rate * step).astype(np.float32)
        if 2 * t > sample.steps:
            mean += weights / (sample.steps - sample.steps // 2)
    return mean


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, sample: Sample) -> float:
    """The share of positives in the unlabelled texts, by the best bin: the
    least ratio of the shares that reach a threshold, with its error margin."""
    half_p, half_u = len(positive) // 2, len(unlabelled) // 2
    weights = fit_risk(positive[:half_p], unlabelled[:half_u], 0.5, sample)
    p, u = positive[half_p:] @ weights, unlabelled[half_u:] @ weights
    cuts = np.quantile(p, np.linspace(0, 0.98, 99))
    reach_p = (p[:, None] >= cuts).mean(0)
    reach_u = (u[:, None] >= cuts).mean(0)
    margin = np.sqrt(np.log(20) / (2 * len(p))) + np.sqrt(np.log(20) / (2 * len(u)))
    best = int(((reach_u + margin) / reach_p).argmin())
    return float(np.clip(reach_u[best] / reach_p[best], 0.05, 0.95))


@dataclass(frozen=True)
class Model:
    """``center`` and ``scale`` of the features, weights with the bias last and
    the class prior."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        x = (rows - self.center) / self.scale
        return _sigmoid(x @ self.weights[:-1] + self.weights[-1])


def _feature_rows(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch):
                rows = features(data, offs).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("is_positive").slice(lo, hi - lo),
                        batch.column("key").slice(lo, hi - lo),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    names=["is_positive", "key", "row"],
                )

    return documents.mapInArrow(run, "is_positive boolean, key long, row binary")


def train(
    documents: DataFrame, labels: DataFrame, training: Column, sample: Sample | None = None
) -> Model:
    """Learn from documents for which ``training`` (over doc_id) holds.

    ``labels`` has doc_id and quality; only quality 1 is used, as the positives.
    Without any positive the prior says it all and every text scores the same.
    """
    sample = sample or Sample()
    key = F.xxhash64("doc_id", "text", F.lit(sample.seed)).alias("key")
    named = documents.select("doc_id", "text").filter(training & F.col("doc_id").isNotNull())
    named = named.select("doc_id", "text", key)
    good = labels.filter("quality = 1").select("doc_id").filter(training).distinct()

    def picked(rows: DataFrame, size: int, positive: bool) -> DataFrame:
        """Keys of rows, by the order of their hashes: of rows and not of ids,
        since one id may have very many."""
        keys = rows.select("key").orderBy("key").limit(size).distinct()
        return keys.withColumn("is_positive", F.lit(positive))

    labelled = named.select("doc_id", "key").join(good, "doc_id", "left_semi")
    chosen = picked(labelled, sample.positives, True).unionByName(picked(named, sample.unlabelled, False))
    # Rows alike in id and text are one here, so the sample's two sizes bound
    # what comes to the driver.
    rows = _feature_rows(named.join(F.broadcast(chosen), "key")).dropDuplicates(["key", "is_positive"]).collect()
    rows.sort(key=lambda r: (r.key, r.row))

    def matrix(positive: bool) -> np.ndarray:
        blobs = [r.row for r in rows if r.is_positive == positive]
        flat = np.frombuffer(b"".join(blobs), np.float16).astype(np.float32)
        return flat.reshape(-1, FEATURES)

    positive, unlabelled = matrix(True), matrix(False)
    if len(positive) < 4 or len(unlabelled) < 4:
        zero, one = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        return Model(zero, one, np.zeros(FEATURES + 1, np.float32), 0.5)
    center = unlabelled.mean(0)
    scale = np.maximum(unlabelled.std(0), 1e-2)

    def scaled(x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - center) / scale, np.ones((len(x), 1), np.float32)])

    positive, unlabelled = scaled(positive), scaled(unlabelled)
    prior = estimate_prior(positive, unlabelled, sample)
    return Model(center, scale, fit_risk(positive, unlabelled, prior, sample), prior)


def score(documents: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``, the chance that the whole text is good, 0 to 1.

    A NULL text counts as an empty one, which has a score as well. A column
    named like the output is replaced. Repeated rows are scored each.
    """
    keep = [c for c in documents.columns if c != out]
    schema = documents.select(*keep).schema.add(out, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.scores(features(data, offs)) for _, _, data, offs in text_blocks(batch, text)]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores.astype(np.float64))],
                names=[*batch.schema.names, out],
            )

    return documents.select(*keep).mapInArrow(run, schema)
