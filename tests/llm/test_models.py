"""Learned operators: held-out accuracy, rules against regular expressions, edges."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanmill.llm import langid, quality, queries, secrets
from loanmill.llm.common import fold

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def remainder(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


# ------------------------------------------------------------------- language


@pytest.fixture(scope="module")
def languages(given):
    return langid.train(given, fold("doc_id", 5) != 0)


def test_language_of_held_out_documents(spark, given):
    truth = {r.doc_id: r.lang for r in given.collect()}
    got = queries.op9_language(spark, SF).collect()
    assert {r.doc_id for r in got} == set(truth)
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_edges(edge_documents, edge_rows, languages):
    rows = langid.identify(edge_documents, languages).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        letters = re.search(r"[^\W\d_]", r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert r.score > 0 if letters else r.score == 0 and r.lang_spans == ""


def test_spans_cover_the_words_of_mixed_text(spark, given, languages):
    texts = {r.lang: r.text for r in given.filter("n_chars between 300 and 900").collect()}
    a, b = texts["de"], texts["en"]
    mixed = spark.createDataFrame([(1, a + " " + b)], "doc_id long, text string")
    spans = [s.split(":") for s in langid.identify(mixed, languages).first().lang_spans.split(",")]
    wrong = 0
    for lang, start, end in spans:
        middle = (int(start) + int(end)) / 2
        wrong += (int(end) - int(start)) * (lang != ("de" if middle < len(a) else "en"))
    assert wrong < 0.1 * len(a + b)


def viterbi_by_force(scores, penalty):
    value, back = scores[0].copy(), []
    for row in scores[1:]:
        best = int(value.argmax())
        stay = value >= value[best] - penalty
        back.append(np.where(stay, np.arange(len(row)), best))
        value = np.where(stay, value, value[best] - penalty) + row
    state = int(value.argmax())
    out = [state]
    for step in reversed(back):
        state = int(step[state])
        out.append(state)
    return sum(scores[i, s] for i, s in enumerate(out[::-1])) - penalty * sum(
        a != b for a, b in zip(out, out[1:])
    )


def test_viterbi():
    rng = np.random.default_rng(3)
    sizes = [5, 0, 1, 40, 17, 40]
    text = np.repeat(np.arange(6), sizes)
    scores = rng.normal(0, 2, (len(text), 4)).astype(np.float32)
    labels = langid.labels_of(scores, text, 6, 3.0)
    for i, n in enumerate(sizes):
        if n:
            own, path = scores[text == i], labels[text == i]
            total = own[np.arange(n), path].sum() - 3.0 * (path[1:] != path[:-1]).sum()
            assert total == pytest.approx(viterbi_by_force(own, 3.0), abs=1e-3)


def test_nothing_to_learn(no_documents, edge_documents):
    model = langid.train(no_documents, F.lit(True))
    assert {r.lang_pred for r in langid.identify(edge_documents, model).collect()} == {"und"}
    assert langid.identify(no_documents, model).count() == 0


def test_scripts(spark):
    rows = [(i, "слово и дело " * 20, "ru") for i in range(5)] + [(9, "word and deed " * 20, "en")]
    rows += [(10, "plain text", None), (11, None, "xx")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert model.languages == ["en", "ru"]
    texts = spark.createDataFrame([(1, "дорога"), (2, "road"), (3, "漢字"), (4, "12 ?")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(texts, model).collect()}
    assert (got[1], got[2], got[4]) == ("ru", "en", "und") and got[3] in ("en", "ru")


# -------------------------------------------------------------------- quality


def test_quality_of_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op4_quality(spark, SF).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    right = [r.predicted == truth[r.doc_id] for r in held]
    assert np.mean(right) >= 0.9
    good = [r.predicted for r in held if truth[r.doc_id] == 1]
    assert np.mean(good) >= 0.98


def test_quality_edges(spark, edge_documents, edge_rows, no_documents):
    labels = spark.createDataFrame([(i, 1) for i, _ in edge_rows if i], "doc_id long, quality int")
    none = quality.train(edge_documents, labels.limit(0), F.lit(True))
    scores = quality.score(edge_documents, none).collect()
    assert len(scores) == len(edge_rows) and {r.score for r in scores} == {0.5}
    small = quality.Sample(positives=10, unlabelled=12, steps=20)
    model = quality.train(edge_documents, labels, F.lit(True), small)
    assert all(0 <= r.score <= 1 for r in quality.score(edge_documents, model).collect())
    assert quality.score(no_documents, model).count() == 0


def test_one_id_in_most_rows_leaves_the_sample_bounded(spark, monkeypatch):
    """What reaches the driver is counted: rows, and not ids with all their rows."""
    rows = [(7, f"text {i} of the same id") for i in range(3000)] + [(7, "again")] * 500
    rows += [(i, f"another text {i}") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), *[(i, i % 2) for i in range(100, 400)]], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "estimate_prior", lambda p, u, _: seen.append((len(p), len(u))) or 0.5)
    model = quality.train(docs, labels, F.lit(True), quality.Sample(positives=40, unlabelled=60, steps=5))
    assert 4 <= seen[0][0] <= 40 and 4 <= seen[0][1] <= 60
    assert quality.score(docs, model).count() == len(rows)


def plain_features(text):
    """The same row, pair by pair and word by word."""
    data = text.encode()
    kinds = [int(quality.KINDS[b]) for b in data]
    pairs = np.zeros(quality.PAIRS)
    for a, b in zip(kinds, kinds[1:]):
        pairs[a * quality.N_KINDS + b] += 1
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    n = max(len(words), 1)
    again = sum(a == b for a, b in zip(words, words[1:]))
    shape = [np.log1p(len(data)), np.log1p(len(data) / n), len(set(words)) / n, np.sqrt(again / n)]
    return np.concatenate([np.sqrt(pairs / max(len(data), 1)), shape])


def test_features_are_those_of_plain_counting(edge_rows):
    texts = [t or "" for _, t in edge_rows]
    blobs = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
    got = quality.features(np.frombuffer(b"".join(blobs), np.uint8), offs)
    for row, text in zip(got, texts):
        assert row == pytest.approx(plain_features(text), abs=1e-5)


@pytest.mark.parametrize("prior", [0.3, 0.9])
def test_step_goes_down_the_risk(prior):
    """The first step's direction is that of the numerical gradient."""
    rng = np.random.default_rng(2)
    p, u = rng.normal(0.5, 1, (1, 4)).astype(np.float32), rng.normal(-0.5, 1, (1, 4)).astype(np.float32)
    loss = lambda x: np.log1p(np.exp(x))

    def risk(w):
        negative = (loss(u @ w) - prior * loss(p @ w)).mean()
        good = prior * loss(-(p @ w)).mean()
        return good + negative if negative >= 0 else -negative

    at = np.zeros(4)
    slope = np.array([(risk(at + h) - risk(at - h)) / 2e-4 for h in 1e-4 * np.eye(4)])
    sample = quality.Sample(steps=1, batch=3, rate=0.1, decay=0.0)
    step = quality.fit_risk(p, u, prior, sample)
    # Adam's first step has the gradient's signs and the size of the rate.
    assert step == pytest.approx(-0.1 * np.sign(slope), abs=1e-4)


def test_prior():
    rng = np.random.default_rng(6)
    good, bad = rng.normal(1.5, 1, (4000, 3)), rng.normal(-1.5, 1, (4000, 3))
    one = np.ones((4000, 1))
    mixed = np.hstack([np.vstack([good[:1400], bad[:600]]), one[:2000]])
    rng.shuffle(mixed)
    mixed, good32, one = mixed.astype(np.float32), good.astype(np.float32), one.astype(np.float32)
    sample = quality.Sample()
    prior = quality.estimate_prior(np.hstack([good32[2000:], one[:2000]]), mixed, sample)
    assert prior == pytest.approx(0.7, abs=0.08)
    weights = quality.fit_risk(np.hstack([good32[2000:], one[:2000]]), mixed, prior, sample)
    assert ((good @ weights[:3] + weights[3]) > 0).mean() > 0.95
    assert ((bad @ weights[:3] + weights[3]) < 0).mean() > 0.95


# -------------------------------------------------------------------- secrets

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def rules(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    names = ("assign", "access", "hex")
    return [f"{names[k]}:{s}:{e}" for s, k, e in sorted(found)]


@pytest.fixture(scope="module")
def network(given):
    return secrets.train(given)


def check(documents, rows, network):
    got = secrets.digests(documents, network).collect()
    assert len(got) == len(rows)
    want = {}
    for doc_id, text in rows:
        want.setdefault(doc_id, []).append(rules(text))
    for r in got:
        options = want[r.doc_id]
        base = next(o for o in options if hashlib.sha256(",".join(o).encode()).hexdigest() == r.base_sha256)
        for kind, n in (("assign", r.n_assign), ("access", r.n_access), ("hex", r.n_hex)):
            assert n == sum(s.startswith(kind) for s in base)
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("network")] == base


def test_rules_of_given_documents(given, network):
    check(given, [(r.doc_id, r.text) for r in given.collect()], network)


def test_rules_of_edge_rows(spark, edge_rows, network):
    key = "0123456789abcdef" * 3
    texts = [
        "password=token:abcdefghij", "TOKEN = 'abcdefgh'", "token=token=abcdefgh", "ſecret=abcdefgh",
        "api_key: short secret=longenough1 passwd:'x'", f"漢字 {key}g{key}", "AKIA" + "B" * 12 + "AKIA",
        "AKIA" + "B" * 11, "xAKIA" + "Z9" * 10, "é" * 40 + "apikey=ABCDEFGHIJ", "a" * 31, "a" * 32,
        "token = " + "Ab9/" * 40, "",
    ]
    rows = [*edge_rows, *[(700 + i, t) for i, t in enumerate(texts)]]
    documents = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")
    check(documents, rows, network)
    masked = {r.doc_id: r for r in secrets.masked(documents, network).collect()}
    assert masked[701].text == "[SECRET]'" and masked[701].spans == "x"
    assert masked[42].text is None and masked[44].text == "one"


def test_network_finds_keys_without_rules(spark, given, network):
    """Keys from the findings, put where no rule sees them."""
    rng = np.random.default_rng(1)
    keys = ["".join(rng.choice(list("0123456789abcdef"), 30)) for _ in range(200)]
    rows = [(i, f"some plain words {k} and more of them") for i, k in enumerate(keys)]
    found = secrets.find(spark.createDataFrame(rows, "doc_id long, text string"), network).collect()
    assert sum("network" in r.spans for r in found) >= 0.8 * len(rows)


def test_without_findings(spark, no_documents, edge_documents):
    network = secrets.train(no_documents)
    assert network.threshold > 1
    assert secrets.find(no_documents, network).count() == 0
    assert all("network" not in r.spans for r in secrets.find(edge_documents, network).collect())


def test_long_candidates_are_read_whole():
    raw = b"x" * 20 + bytes(range(48, 58)) * 30 + b"y" * 20
    rows = secrets.windows(raw, 20, 320)
    assert all(len(r) == secrets.WINDOW for r in rows)
    seen = set()
    for i in range(len(rows)):
        start = 20 + i * secrets.WITHIN // 2
        seen |= set(range(start, min(start + secrets.WITHIN, 320)))
    assert seen == set(range(20, 320))
