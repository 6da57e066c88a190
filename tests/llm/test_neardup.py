import itertools
import random
import re

import pytest

from loanmill.llm import neardup


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def by_force(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def check(documents, rows, words, percent):
    got = neardup.near_duplicates(documents, neardup.Likeness(words, percent)).collect()
    assert len(got) == len(rows)
    want = by_force(rows, words, percent)
    for r in got:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert tuple(r)[1:] == want[r.doc_id], r


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_edge_rows(edge_documents, edge_rows, words, percent):
    check(edge_documents, edge_rows, words, percent)


def test_given_documents(some_documents):
    check(some_documents, [(r.doc_id, r.text) for r in some_documents.collect()], 3, 85)


def test_copies_that_are_not_all_alike(spark):
    """A chain, a hub whose copies are unlike each other, and a crowd."""
    rng = random.Random(9)
    base = [f"t{rng.randint(0, 5000)}" for _ in range(220)]
    rows, number = [], itertools.count(1)

    def add(words):
        rows.append((next(number), " ".join(words)))

    for i in range(12):  # every one has other words changed than the hub
        add([f"n{i}" if k in (10 + 9 * i, 100 + 9 * i) else w for k, w in enumerate(base)])
    for i in range(60):
        add([f"m{i}" if k in ((7 * i) % 220, (7 * i + 110) % 220, (13 * i + 50) % 220) else w for k, w in enumerate(base)])
    add(base)
    chain = [f"c{rng.randint(0, 5000)}" for _ in range(200)]
    for i in range(10):
        chain = [f"x{i}" if k in (15 * i, 15 * i + 5) else w for k, w in enumerate(chain)]
        add(chain)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    check(documents, rows, 3, 85)


def test_copies_unlike_each_other_are_not_all_paired(spark, monkeypatch):
    """A crowd around one text, most of it linked with none: as many pairs are
    looked at as there are copies, and the few links among them are found."""
    rng = random.Random(4)
    base = [f"t{rng.randint(0, 5000)}" for _ in range(150)]

    def changed(words, places, by):
        return [f"{by}{k}" if k in places else w for k, w in enumerate(words)]

    rows = [(1, " ".join(base))]
    for i in range(150):  # a third of them is linked with the text
        places = set(rng.sample(range(150), 4 if i % 3 == 0 else rng.randint(9, 11)))
        rows.append((10 + i, " ".join(changed(base, places, f"n{i}x"))))
    for i in range(20, 32):  # copies of unlinked copies, and shorter ones
        words = rows[i][1].split()
        rows.append((400 + i, " ".join(changed(words, {3 + i, 90 + i}, f"m{i}x"))))
        rows.append((500 + i, " ".join(words[: 150 - i // 2])))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    counts, confirmed = [], neardup._confirmed

    def counting(pairs, *others):
        counts.append(pairs.count())
        return confirmed(pairs, *others)

    monkeypatch.setattr(neardup, "_confirmed", counting)
    check(documents, rows, 3, 85)
    assert counts[-1] < 3 * len(rows)


def test_kept_documents(edge_documents, edge_rows):
    kept = neardup.kept_documents(edge_documents, neardup.Likeness(3, 85))
    assert kept.columns == edge_documents.columns
    want = {i for i, v in by_force(edge_rows, 3, 85).items() if v[2]}
    assert {r.doc_id for r in kept.collect()} == want | {None}


def test_no_rows(no_documents):
    assert neardup.near_duplicates(no_documents).count() == 0
