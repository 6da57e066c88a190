import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanmill.llm import katz
from loanmill.llm.common import fold


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


class Force:
    """The model as its definition says, one token at a time."""

    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        for text in texts:
            own = tokens(text)
            self.one.update(own)
            self.two.update(zip(["<s>", *own], own))
        self.n = sum(self.one.values())
        self.history = Counter({"<s>": len(texts), **{w: c for w, c in self.one.items() if w is not None}})
        self.followers = defaultdict(list)
        for (h, w), c in self.two.items():
            self.followers[h].append((w, c))
        self.d1 = katz.discounts([sum(c == r for c in self.one.values()) for r in range(1, katz.KEPT + 2)])
        self.d2 = katz.discounts([sum(c == r for c in self.two.values()) for r in range(1, katz.KEPT + 2)])
        self.left = self.n - sum(self.d(self.d1, c) * c for c in self.one.values())

    @staticmethod
    def d(table, count):
        return table[count] if count <= katz.KEPT else 1.0

    def p1(self, w):
        c, spare = self.one[w], 0 if self.left > 1e-9 else 1
        return (self.d(self.d1, c) * c if c else self.left + spare) / max(self.n + spare, 1)

    def p2(self, w, h):
        c_h = self.history[h]
        if not c_h:
            return self.p1(w)
        few = any(c <= katz.KEPT for _, c in self.followers[h])
        n_h = c_h + (c_h > katz.LARGE or not few)
        c = self.two[h, w]
        if c:
            return self.d(self.d2, c) * c / n_h
        left = 1 - sum(self.d(self.d2, c) * c for _, c in self.followers[h]) / n_h
        return left / (1 - sum(self.p1(x) for x, _ in self.followers[h])) * self.p1(w)

    def expected(self, text):
        own = tokens(text)
        base = sum(math.log10((self.one[w] + 1) / (self.n + len(self.one) + 1)) for w in own)
        score = sum(math.log10(self.p2(w, h)) for h, w in zip(["<s>", *own], own))
        return len(own), sum(self.one[w] > 0 for w in own), self.n, base, score


def remainder(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 7


def check(documents, rows):
    model = Force([t for i, t in rows if i is not None and remainder(i) != 2])
    got = katz.score(documents, fold("doc_id", 7) != 2).collect()
    assert len(got) == len(rows)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for r in got:
        assert r.held_out == (r.doc_id is None or remainder(r.doc_id) == 2)
        want = model.expected(texts[r.doc_id][0])
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert (r.base_score, r.score) == pytest.approx(want[3:], rel=1e-9, abs=1e-9), r.doc_id
    return model


def test_edge_rows(edge_documents, edge_rows):
    check(edge_documents, edge_rows)


def test_given_documents(some_documents):
    rows = [(r.doc_id, r.text) for r in some_documents.collect()]
    model = check(some_documents, rows)
    held = [model.expected(t) for i, t in rows if remainder(i) == 2]
    assert sum(x[4] for x in held) > sum(x[3] for x in held)


def test_spread_histories_and_several_chunks(some_documents, monkeypatch):
    monkeypatch.setattr(katz, "LARGE", 40)
    monkeypatch.setattr(katz, "CHUNK", 20_000)
    monkeypatch.setattr(katz, "BUCKET_BYTES", 10_000)
    check(some_documents, [(r.doc_id, r.text) for r in some_documents.collect()])


def test_places_of_a_frequent_pair_lie_in_no_bucket(spark, monkeypatch):
    """Nearly every document has it; no bucket holds a good part of them."""
    monkeypatch.setattr(katz, "LARGE", 40)
    monkeypatch.setattr(katz, "CHUNK", 3000)
    monkeypatch.setattr(katz, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(katz, "PIECE", 100, raising=False)
    seen, staged = {}, katz.staged
    monkeypatch.setattr(katz, "staged", lambda df, name, **more: seen.setdefault(name, staged(df, name, **more)))
    rows = [(i, f"the the the w{i} x{i}" if i % 9 else f"y{i}") for i in range(2000)] + [(3, "the the the w3 x3")]
    check(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), rows)
    shares = seen["shares"].filter("bucket >= 0").groupBy("bucket").agg(F.sum(F.octet_length("sure")).alias("n"))
    assert shares.agg(F.max("n")).first()[0] / 8 < len(rows) / 3


def test_shares_are_stored_in_small_rows(some_documents, monkeypatch):
    """Readers hold a row group: all cells of a bucket in a row are too many."""
    monkeypatch.setattr(katz, "LARGE", 40)
    monkeypatch.setattr(katz, "PIECE", 150, raising=False)
    seen, staged = {}, katz.staged
    monkeypatch.setattr(katz, "staged", lambda df, name, **more: seen.setdefault(name, staged(df, name, **more)))
    check(some_documents, [(r.doc_id, r.text) for r in some_documents.collect()])
    shares = seen["shares"].filter("bucket >= 0")
    assert shares.agg(F.max(F.octet_length("sure"))).first()[0] <= 8 * 150 < shares.agg(F.sum(F.octet_length("sure"))).first()[0]
    assert shares.filter("sums is not null").count() == shares.select("bucket").distinct().count() < shares.count()


def test_probabilities_add_up_to_one(some_documents):
    model = Force([r.text for r in some_documents.limit(40).collect()])
    words = [*model.one, "a word that is not there"]
    assert sum(model.p1(w) for w in words) == pytest.approx(1)
    frequent = [h for h, _ in model.history.most_common(3)]
    for h in ["<s>", *frequent, next(w for w, c in model.one.items() if c == 1 and w), "not there"]:
        assert sum(model.p2(w, h) for w in words) == pytest.approx(1)


def test_nothing_to_learn(edge_documents, edge_rows, no_documents):
    got = katz.score(edge_documents, F.lit(False)).collect()
    assert len(got) == len(edge_rows)
    assert all(r.held_out and r.score == r.base_score == 0 and r.train_tokens == 0 for r in got)
    assert katz.score(no_documents, F.lit(True)).count() == 0


def test_planes():
    x = np.array([0, 1, 255, 256, 2**39, 2**40 - 1])
    assert katz.unplanes(katz.planes(x)).tolist() == x.tolist()
    assert len(katz.unplanes(b"")) == 0


def test_discounts():
    assert katz.discounts([0] * 6)[1:].tolist() == pytest.approx([0.5, 0.75, 5 / 6, 0.875, 0.9])
    d = katz.discounts([1000, 400, 220, 140, 100, 75])
    assert all(0 < x < 1 for x in d[1:]) and d[1] < d[3]
