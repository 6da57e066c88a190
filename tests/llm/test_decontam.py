import random

import numpy as np
import pytest

from loanmill.llm import decontam


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(300)] + ["the", "of", "and"] * 40

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = {i: prose(rng.randint(12, 60)) for i in range(40)}
    rows, leaks = [], set()
    for doc in range(200):
        words = prose(rng.randint(20, 400))
        if doc % 4 == 0:
            item = doc // 4 % 40
            copy = list(items[item])
            for _ in range(int(0.1 * len(copy)) if doc % 8 else 0):
                at = rng.randrange(1, len(copy))
                what = rng.random()
                if what < 0.4:
                    copy[at] = "edited"
                elif what < 0.7:
                    copy.insert(at, "added")
                else:
                    del copy[at]
            cut = rng.randint(0, len(words))
            words = words[:cut] + [w.upper() + "," for w in copy] + words[cut:]
            leaks.add((doc, item, doc % 8 == 0))
        rows.append((doc, " ".join(words), "item", 1))
    rows += [(500, None, None, 1), (501, "", "x", 1), (502, " ?! ", "x", 1), (None, "none", "x", 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, item_id string, edits int")
    bench = [(i, " ".join(w)) for i, w in items.items()]
    bench += [(90, None), (91, ""), (92, "too short"), (None, " ".join(items[0]))]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    return documents, benchmark, leaks


def test_passages(planted):
    documents, benchmark, leaks = planted
    got = decontam.passages(documents, benchmark).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert len(got) == len(pairs)
    assert {(d, i) for d, i, exact in leaks if exact} <= pairs
    assert all(r.edits <= 0.2 * r.item_words for r in got)
    assert all(r.edits == 0 for r in got if (r.doc_id, r.item_id, True) in leaks)
    edited = {(d, i) for d, i, exact in leaks if not exact}
    assert len(edited & pairs) >= 0.9 * len(edited)
    assert pairs <= {(d, i) for d, i, _ in leaks}


def distance_by_force(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row


def test_edit_distance():
    rng = np.random.default_rng(5)
    for _ in range(300):
        item = rng.integers(1, 6, rng.integers(1, 15)).astype(np.uint64)
        window = rng.integers(1, 6, rng.integers(0, 18)).astype(np.uint64)
        ends = distance_by_force(item.tolist(), window.tolist())
        for most in (0, 2, 20):
            edits, length = decontam.edit_distance(item, window, most)
            if min(ends) <= most:
                assert edits == min(ends) and ends[length] == edits
            else:
                assert edits == most + 1


def edited(rng, words, at):
    """The words with an edit at each of the places."""
    out = list(words)
    for i in sorted(at, reverse=True):
        what = rng.random()
        if what < 0.5:
            out[i] = f"edit{rng.randrange(1000)}"
        elif what < 0.75:
            out.insert(i, f"more{rng.randrange(1000)}")
        else:
            del out[i]
    return out


def test_edits_at_every_place(spark):
    """A fifth of the words edited: at random, at the front, at the end, evenly
    and in each stretch of the item, against edit distance by force."""
    rng = random.Random(3)
    items, rows, own = [], [], {}
    for n in (5, 9, 12, 20, 40, 80, 130):
        item = [f"u{rng.randrange(10**6)}" for _ in range(n)]
        items.append(item)
        k = n // 5
        places = [range(k), range(n - k, n), range(0, 5 * k, 5), range(4, 5 * k, 5)]
        places += [range(s, s + k) for s in range(0, n - k, max(1, n // 8))]
        places += [rng.sample(range(n), k) for _ in range(12)]
        for at in places:
            before = [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(6))]
            after = [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(6))]
            own[len(rows)] = len(items) - 1
            rows.append((len(rows), before + edited(rng, item, at) + after))
    documents = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    benchmark = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"
    )
    want = set()
    for doc, words in rows:
        item = items[own[doc]]
        n, k = len(item), len(item) // 5
        best = (k + 1, 0, 0)
        for start in range(min(len(words), 12 + k)):
            ends = distance_by_force(item, words[start : start + n + k])
            best = min(best, (min(ends), start, start + ends.index(min(ends))))
        assert best[0] <= k
        want.add((doc, own[doc], best[1], best[2], n, best[0]))
    assert {tuple(r) for r in decontam.passages(documents, benchmark).collect()} == want


def test_clean_documents(planted):
    documents, benchmark, _ = planted
    found = {r.doc_id for r in decontam.passages(documents, benchmark).collect()}
    kept = decontam.clean_documents(documents, benchmark)
    assert kept.columns == documents.columns
    left = {r.doc_id for r in kept.collect()}
    assert left == {r.doc_id for r in documents.collect()} - found


def test_clean_rows_stay_whatever_their_id(planted, spark, monkeypatch):
    _, benchmark, _ = planted
    leak = benchmark.filter("item_id = 7").first().text
    rows = [(None, f"so {leak} on", 1), (None, "clean", 2), (None, None, 3)]
    rows += [(4, "clean too", 4), (4, leak, 5), (5, leak + " end", 6), (6, "", 7)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n int")
    for items in (20_000, 15):
        monkeypatch.setattr(decontam, "ITEMS_PER_SCAN", items)
        kept = decontam.clean_documents(documents, benchmark).collect()
        assert sorted(map(tuple, kept), key=lambda r: r[2]) == [r for r in rows if r[2] in (2, 3, 4, 7)]


def test_several_scans(planted, monkeypatch):
    documents, benchmark, _ = planted
    whole = {tuple(r) for r in decontam.passages(documents, benchmark).collect()}
    monkeypatch.setattr(decontam, "ITEMS_PER_SCAN", 15)
    assert {r[:2] for r in whole} == {
        (r.doc_id, r.item_id) for r in decontam.passages(documents, benchmark).collect()
    }


def test_blocks_of_one_id(planted, spark, monkeypatch):
    """Many texts under one id, and rows that are repeated."""
    _, benchmark, _ = planted
    texts = [r.text for r in benchmark.filter("item_id < 40").collect()]
    rows = [(1, t) for t in texts] + [(2, texts[0])] * 60
    items = spark.createDataFrame(rows, "item_id long, text string")
    monkeypatch.setattr(decontam, "ITEMS_PER_SCAN", 10)
    blocks, parts = decontam._blocks(items, decontam.Search())
    sizes = [len(p.ids) for p in parts]
    assert blocks == 5 and sum(sizes) == 41 and max(sizes) <= 20
    monkeypatch.setattr(decontam, "ITEM_BYTES", 1000)
    assert decontam._blocks(items, decontam.Search())[0] > 5


def test_given_documents(some_documents, spark):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = {
        (d.doc_id, b.item_id)
        for d in some_documents.collect()
        for b in benchmark.collect()
        if b.text in d.text
    }
    got = {(r.doc_id, r.item_id) for r in decontam.passages(some_documents, benchmark).collect()}
    assert want <= got and want


def test_no_rows(no_documents, planted, spark):
    assert decontam.passages(no_documents, planted[1]).count() == 0
    assert decontam.passages(planted[0], planted[1].limit(0)).count() == 0
