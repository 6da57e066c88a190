import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loanmill.llm import manifest

KINDS = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, n int, leaf int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = [row[0], row[1], row[2], row[3], text]
    told = ["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields]
    return h(*told)


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def up(nodes):
    """All levels of a tree of nodes, the last one its top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[a : a + 16]) for a in range(0, len(below), 16)])
    return levels


def walk(levels, place, changed):
    """Siblings up to the top, and the top with a changed node at the place."""
    proof = ""
    for nodes in levels[:-1]:
        a = place // 16 * 16
        run = nodes[a : a + 16]
        slot = place - a
        proof += "".join(run[:slot] + run[slot + 1 :])
        changed = h(*run[:slot], changed, *run[slot + 1 :])
        place //= 16
    return proof, changed


def by_force(rows, every=5):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    for source, own in by_source.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: up([leaf_of(r, r[4]) for r in by_source[s]]) for s in names}
    if not names:
        return []
    over = up([trees[s][-1][0] for s in names])
    out = []
    for i, s in enumerate(names):
        for place, row in enumerate(by_source[s]):
            own = leaf_of(row, row[4])
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % every == 0
            proof, node = walk(trees[s], place, leaf_of(row, lowered(row[4])) if tampered else own)
            more, root = walk(over, i, node)
            out.append((row[0], own, trees[s][-1][0], over[-1][0], h(proof + more), root, root == over[-1][0]))
    return sorted(out, key=repr)


def found(spark, rows, height=manifest.HEIGHT):
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], KINDS)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return sorted((tuple(r) for r in manifest.manifest(docs, changed, height).collect()), key=repr)


def made(rng, n, source):
    return [
        (rng.randint(0, 5 * n), source, rng.choice(["en", "de", None]), rng.choice([None, 3]), rng.choice(["Ab", "ß C", "", None]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("height", [1, 2])
def test_against_force(spark, monkeypatch, height):
    """Sources of every size around 16 and 256, repeated rows, NULLs."""
    monkeypatch.setattr(manifest, "ROWS_PER_TASK", 100)
    rng = random.Random(2)
    sizes = [1, 2, 15, 16, 17, 31, 255, 256, 257, 600]
    rows = [row for i, n in enumerate(sizes) for row in made(rng, n, f"s{i}")]
    rows += made(rng, 20, None) + made(rng, 3, "") + made(rng, 2, "Ünï") + made(rng, 2, "😀")
    rows += [(None, "s1", "en", 1, "Null id"), (None, "s1", "en", 1, "Null id"), (7, "s2", None, None, None)]
    rows += [(9, "s3", "en", 2, "Same")] * 300
    assert found(spark, rows, height) == by_force(rows)


def test_many_sources(spark):
    rng = random.Random(3)
    rows = [row for i in range(300) for row in made(rng, 1 + i % 3, f"site-{i}.org")]
    assert found(spark, rows) == by_force(rows)


@pytest.mark.parametrize("rows", [[], [(0, None, None, None, None)], [(1, "a", "en", 1, "X"), (5, "b", "en", 1, "Y")]])
def test_tiny(spark, rows):
    assert found(spark, rows) == by_force(rows)


def test_edges(edge_documents, edge_rows, spark):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in edge_documents.collect()]
    assert sorted((tuple(r) for r in manifest.digests(edge_documents).collect()), key=repr) == by_force(rows)


def test_every_row_changed_or_none(spark):
    rows = [(i, "s", "en", 1, "Text") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest.manifest(docs, F.lit(True)).filter("verified").count() == 0
    assert manifest.manifest(docs, F.lit(None).cast("boolean")).filter("verified").count() == 40


def test_fold_goes_on_from_the_kept_state():
    """Left siblings are not hashed again: their texts may be gone by then."""
    kids = [h(str(i)) for i in range(16)]
    parent = manifest.Parent(list(kids))
    other = h("other")
    for slot in range(16):
        parent.children = [None] * (slot + 1) + kids[slot + 1 :]
        assert parent.folded(slot, other) == h(*kids[:slot], other, *kids[slot + 1 :])
        assert parent.folded(slot, kids[slot]) == parent.node


def test_hot_source_is_spread(spark, monkeypatch):
    """Rows of one source, even of one id, get their places in many tasks."""
    monkeypatch.setattr(manifest, "ROWS_PER_TASK", 1000)
    docs = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 1, id) as doc_id", "'hot' as source", "'en' as lang", "id as n_chars", "'x' as text"
    )
    rows = manifest.staged(manifest.leaves(docs, F.lit(False)), "test")
    placed = manifest.staged(manifest.placed(rows, ["doc_id", "leaf"]), "test")
    assert placed.agg(F.min("pos"), F.max("pos"), F.count_distinct("pos"), F.max("n")).first() == (0, 19_999, 20_000, 20_000)
