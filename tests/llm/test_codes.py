import hashlib
import math

import numpy as np
import pytest

from loanmill.llm import codes

INF, NAN = float("inf"), float("nan")


def by_force(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Plain Lloyd rounds over (vec_id, vector, label) rows of one length."""
    kept = [
        (i, [math.floor(scale * x) for x in v], lab)
        for i, v, lab in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return {}, ""
    length = len(kept[0][1])
    at = [i * length // parts for i in range(parts + 1)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][a:b] for r in order] for a, b in zip(at, at[1:])]

    def assign():
        found = []
        for _, v, _ in kept:
            best = []
            for (a, b), book in zip(zip(at, at[1:]), books):
                best.append(min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), j) for j, e in enumerate(book)))
            found.append(best)
        return found

    for _ in range(rounds):
        found = assign()
        for p, (a, b) in enumerate(zip(at, at[1:])):
            for j in range(len(books[p])):
                own = [v[a:b] for (_, v, _), best in zip(kept, found) if best[p][1] == j]
                if own:
                    books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    digest = hashlib.sha256(",".join(str(x) for bk in books for e in bk for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in best) for best in found]
    of_label = {}
    for (_, _, lab), e in zip(kept, errors):
        of_label[lab] = of_label.get(lab, 0) + e
    out = [
        (i, "".join(f"{j:02x}" for _, j in best), e, of_label[lab], digest)
        for (i, _, lab), best, e in zip(kept, found, errors)
    ]
    return sorted(out, key=repr), digest


def found(spark, rows):
    vectors = spark.createDataFrame(
        [(i, v, lab, "x", 1) for i, v, lab in rows],
        "vec_id long, embedding array<double>, label int, codes string, v int",
    )
    return sorted((tuple(r) for r in codes.digests(vectors).collect()), key=repr)


def test_against_force(spark):
    """More vectors than entries, ties, repeated rows, odd values, NULL ids."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 8).astype(float).__truediv__(1024).tolist(), i % 5 if i % 7 else None) for i in range(700)]
    rows += [rows[0], rows[0], (5000, None, 1), (5001, [0.1] * 7 + [None], 1), (5002, [NAN] + [0.0] * 7, 1)]
    rows += [(5003, [INF] + [0.0] * 7, 2), (None, [0.25] * 8, 3), (4, [-0.5] * 8, 3)]
    assert found(spark, rows) == by_force(rows)[0]


def test_fewer_vectors_than_entries_and_large_components(spark):
    rows = [(9 - i, [1000.5 * i, -77.25 * i, 3.0, -4000.125 + i], 0) for i in range(10)]
    assert found(spark, rows) == by_force(rows)[0]


def test_lengths_apart_and_empty_vectors(spark):
    a = [(i, [float(i % 9), float(i % 4), 0.5], 1) for i in range(300)]
    b = [(1000 + i, [float(i % 3)] * 4, 2) for i in range(20)]
    got = {r[0]: r[1:3] for r in found(spark, a + b + [(2000, [], 3)])}
    want = {r[0]: r[1:3] for rows in (a, b) for r in by_force(rows)[0]}
    assert got.pop(2000) == ("00000000", 0)
    assert got == want


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 2)]) == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="do not fit 64 bits"):
        found(spark, [(1, [1e13, 0.0, 0.0, 0.0], 1), (2, [-1e13, 0.0, 0.0, 0.0], 1)])


def test_active_scan_is_a_full_scan():
    """Ties and moved entries: the same code and distance from less work."""
    rng = np.random.default_rng(8)
    for _ in range(200):
        points = rng.integers(0, 4, (60, 2))
        old = rng.integers(0, 4, (12, 2))
        code, dist = codes.full_scan(points, old)
        new = old.copy()
        moved = rng.random(12) < 0.3
        new[moved] += rng.integers(1, 3, (int(moved.sum()), 2))
        got = codes.active_scan(points, new, moved, code, dist)
        for a, b in zip(got, codes.full_scan(points, new)):
            assert (a == b).all()


def test_fixed_entries_are_not_compared(monkeypatch):
    """A part whose entry stayed meets the moved entries only."""
    seen = []
    whole = codes.distances
    points, entries = np.arange(20).reshape(10, 2), np.arange(0, 20, 2).reshape(5, 2)
    code, dist = codes.full_scan(points, entries)
    monkeypatch.setattr(codes, "distances", lambda p, e: seen.append((len(p), len(e))) or whole(p, e))
    moved = np.array([True, False, False, False, False])
    codes.active_scan(points, entries, moved, code, dist)
    lost = int((code == 0).sum())
    assert seen == [(lost, 5), (10 - lost, 1)]


def test_decode(spark):
    rows = [(i, [i / 1024, 0.0, -i / 1024, 2.0]) for i in range(40)]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int")
    state, books = codes.encode(vectors)
    assert {r.vec_id: list(r.embedding) for r in codes.decode(state, books).collect()} == dict(rows)
