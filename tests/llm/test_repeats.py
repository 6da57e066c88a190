import hashlib
import re

import numpy as np
import pytest

from loanmill.llm import anchors, exchange, suffix


def words_by_force(rows, window):
    """Contract of the word passages, one dictionary of all windows."""
    first, split = {}, {}
    for doc_id, text in sorted((r for r in set(rows) if r[0] is not None), key=lambda r: r[0]):
        words = split[doc_id] = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for s in range(len(words) - window + 1):
            first.setdefault(tuple(words[s : s + window]), (doc_id, s))
    out = {}
    for doc_id, words in split.items():
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (doc_id, s):
                gone[s : s + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[doc_id] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def bytes_by_force(rows, length):
    first, raw = {}, {}
    for doc_id, text in sorted((r for r in set(rows) if r[0] is not None), key=lambda r: r[0]):
        data = raw[doc_id] = (text or "").encode()
        for s in range(len(data) - length + 1):
            first.setdefault(data[s : s + length], doc_id)
    out = {}
    for doc_id, data in raw.items():
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - length + 1):
            if first[data[s : s + length]] < doc_id:
                gone[s : s + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def given(some_documents):
    return [(r.doc_id, r.text) for r in some_documents.collect()]


def test_words_of_edge_rows(edge_documents, edge_rows):
    got = anchors.digests(edge_documents).collect()
    want = words_by_force(edge_rows, 20)
    assert len(got) == len(edge_rows)
    for r in got:
        if r.doc_id is None:
            assert (r.n_words, r.n_removed) == (45, 0)
        else:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id], r.doc_id


def test_words_of_given_documents(some_documents, given):
    want = words_by_force(given, 20)
    got = {r.doc_id: tuple(r)[1:] for r in anchors.digests(some_documents).collect()}
    assert got == want and any(r[1] for r in want.values())


def test_bytes_of_edge_rows(edge_documents, edge_rows):
    got = suffix.digests(edge_documents).collect()
    want = bytes_by_force(edge_rows, 50)
    assert len(got) == len(edge_rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert tuple(r)[1:] == want[r.doc_id], r.doc_id


def test_bytes_of_given_documents(some_documents, given):
    want = bytes_by_force(given, 50)
    got = {r.doc_id: tuple(r)[1:] for r in suffix.digests(some_documents).collect()}
    assert got == want and any(r[1] for r in want.values())


def test_words_in_several_chunks(edge_documents, edge_rows, monkeypatch):
    monkeypatch.setattr(exchange, "CHUNK", 500)
    monkeypatch.setattr(anchors, "BUCKET_BYTES", 2000)
    want = words_by_force(edge_rows, 12)
    for r in anchors.remove_repeats(edge_documents, 12, 6).collect():
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed) == want[r.doc_id][:2]


def test_bytes_in_several_shards(edge_documents, edge_rows, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD_BYTES", 2000)
    monkeypatch.setattr(suffix, "MANY_PIECES", 2)
    monkeypatch.setattr(exchange, "CHUNK", 500)
    want = bytes_by_force(edge_rows, 30)
    for r in suffix.remove_repeats(edge_documents, 30).collect():
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans) == want[r.doc_id][:3]


def test_bytes_many_times_in_a_late_document(spark, monkeypatch):
    """A passage 20 times in a late document, once or twice in early ones."""
    monkeypatch.setattr(suffix, "SHARD_BYTES", 500)
    rows = []
    for i in range(12):
        passage = " ".join(hashlib.sha256(f"{i} {j}".encode()).hexdigest() for j in range(2))
        rows.append((i, f"early {i} {passage} end" + (f" {i} again {passage}" if i % 3 == 0 else "")))
        rows.append((100 + i, "".join(f"{chr(97 + j) * 60}{passage}" for j in range(20))))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    want = bytes_by_force(rows, 50)
    got = {r.doc_id: tuple(r)[1:] for r in suffix.digests(documents).collect()}
    assert got == want and all(want[100 + i][1] >= 20 * 129 for i in range(12))


def test_no_rows(no_documents):
    assert anchors.digests(no_documents).count() == 0
    assert suffix.digests(no_documents).count() == 0


def test_suffix_classes():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[3000:3600] = data[100:700]
    bounds = np.array([0, 1500, 2900, 4000])
    suffixes, firsts = suffix.shard_classes(data, bounds, 30)
    raw = data.tobytes()
    strings = [raw[s : s + 30] for s in suffixes]
    assert strings == sorted(strings)
    assert len(strings) == sum(b - a - 29 for a, b in zip(bounds, bounds[1:]))
    starts = [i for i in range(len(strings)) if i == 0 or strings[i] != strings[i - 1]]
    assert firsts.tolist() == starts


@pytest.mark.parametrize("seed", range(40))
def test_classes_of_texts_with_many_repeats(seed):
    """Regions that are pieces of each other, with edits: neighbours in order
    that are equal, that end, or that part just beyond the length."""
    rng = np.random.default_rng(seed)
    source = rng.integers(97, 97 + int(rng.integers(2, 6)), 300).astype(np.uint8)
    parts = []
    for _ in range(int(rng.integers(5, 40))):
        at = int(rng.integers(0, 240))
        part = source[at : at + int(rng.integers(30, 60))].copy()
        if rng.random() < 0.6:
            part[rng.integers(0, len(part))] = 97
        parts.append(part)
    data = np.concatenate(parts)
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    suffixes, firsts = suffix.shard_classes(data, bounds, 30)
    raw = data.tobytes()
    strings = [raw[s : s + 30] for s in suffixes]
    assert strings == sorted(strings)
    assert len(strings) == sum(len(p) - 29 for p in parts)
    assert firsts.tolist() == [i for i in range(len(strings)) if i == 0 or strings[i] != strings[i - 1]]


@pytest.mark.parametrize("kind", ["u4", "u8"])
def test_packed_records(kind):
    rng = np.random.default_rng(1)
    docs = np.repeat([5, -3, 2**40], [700, 1, 300])
    positions = np.concatenate([np.cumsum(rng.integers(1, 200_000, n)) for n in (700, 1, 300)])
    keys = rng.integers(0, 2**63, len(docs), dtype=np.uint64) * np.uint64(2)
    if kind == "u4":
        keys = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    packed = exchange.pack(docs % 3, docs, positions, keys)
    import pyarrow as pa

    seen = []
    for row in range(packed.num_rows):
        d, p, k = exchange.unpack(pa.Table.from_batches([packed.slice(row, 1)]), "<" + kind)
        seen += zip(d.tolist(), p.tolist(), k.tolist())
    want = zip(docs.tolist(), positions.tolist(), keys.tolist())
    assert sorted(seen) == sorted(want)


def test_window_must_hold_a_block(edge_documents):
    with pytest.raises(ValueError):
        anchors.repeated_windows(edge_documents, 18, 10)
    with pytest.raises(ValueError):
        suffix.repeated_strings(edge_documents, 20)
