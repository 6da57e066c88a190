"""A Merkle manifest of a dataset: a tree for each source, and one over sources.

A row's leaf is the digest of its fields. A tree's nodes, in order, become
parents sixteen at a time until one is left. A parent is hashed child by child
and keeps a copy of the hash state from before each child; a changed child is
folded by going on from the copy at its slot, over the new digest and the
siblings right of it. What lies left of it is not hashed again.

Leaves are hashed where their rows are scanned; texts do not move. Their places
come from a range sort of the digests alone, so a source with a third of all rows
is spread over many tasks. A task builds the parents of one block of 16**2 nodes
and sends the block's top node on. Blocks of tops are built the same way until each
tree has one node, and the paths down from there (the runs of siblings) meet the
leaves again, one path for a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanmill.llm.common import staged

FAN_OUT = 16
#: Levels of parents that one task builds at a time.
HEIGHT = 2
#: Rows of a task that gives leaves their places, and the least number of tasks.
ROWS_PER_TASK, TASKS = 250_000, 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each `-` if NULL, else its bytes' count, a colon
    and its value as text."""
    told = []
    for field in fields:
        value = field.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*told), 256))


def tree_name(source: Column) -> Column:
    """The source as a text that is never NULL and sorts as sources do."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def leaves(documents: DataFrame, changed: Column) -> DataFrame:
    """``doc_id``, ``tree``, ``leaf`` and, where ``changed``, ``other``: the
    leaf of the same row with A-Z of its text in lower case."""
    lower = F.translate("text", _UPPER, _UPPER.lower())
    values = [F.col(name) for name in FIELDS]
    other = F.when(changed, digest(*values[:-1], lower))
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        tree_name(F.col("source")).alias("tree"),
        digest(*values).alias("leaf"),
        other.alias("other"),
    )


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows of a stored table with ``pos``, their place from 0 among their
    tree's rows by ``order``, and ``n``, the number of these.

    Rows are range sorted by tree, order and a number of their own, so equal
    keys are dealt over several tasks too; tasks' counts give their offsets.
    """
    tasks = max(TASKS, 1 + rows.count() // ROWS_PER_TASK)
    dealt = rows.withColumn("_row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(tasks, "tree", *order, "_row")
    dealt = staged(dealt.withColumn("_task", F.spark_partition_id()), "dealt")
    before = W.partitionBy("tree").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("tree", "_task")
        .agg(F.count("*").alias("rows"))
        .select(
            "tree",
            "_task",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
            F.sum("rows").over(W.partitionBy("tree")).alias("n"),
        )
    )
    own = W.partitionBy("tree", "_task").orderBy(*order, "_row")
    return (
        dealt.join(offsets, ["tree", "_task"])
        .withColumn("pos", F.col("offset") + F.row_number().over(own) - 1)
        .drop("_task", "_row", "offset")
    )


class Parent:
    """A node over a run of children, with the hash state before each child."""

    def __init__(self, children: list[str]) -> None:
        self.children, self.states = children, []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.node = state.hexdigest()

    def folded(self, slot: int, child: str) -> str:
        """The node with another child at the slot: the state kept there goes
        on over the child and its right siblings."""
        state = self.states[slot].copy()
        state.update("".join([child, *self.children[slot + 1 :]]).encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> str:
        return "".join([*self.children[:slot], *self.children[slot + 1 :]])


def runs(nodes: list[str]) -> list[Parent]:
    return [Parent(nodes[a : a + FAN_OUT]) for a in range(0, len(nodes), FAN_OUT)]


def levels(nodes: list[str], n: int, height: int) -> list[list[Parent]]:
    """The parents, level by level, over one block of a tree of ``n`` nodes.

    A level is there while the whole tree has several nodes, so the lone last
    node of a large tree gets parents, and a tree of one node none."""
    built = []
    while n > 1 and len(built) < height:
        built.append(runs(nodes))
        nodes = [parent.node for parent in built[-1]]
        n = -(-n // FAN_OUT)
    return built


def path_of(parents: list[list[Parent]], place: int) -> list[tuple[int, list[str]]]:
    """Slot and children of the runs above a node of the block."""
    path = []
    for level in parents:
        place, slot = divmod(place, FAN_OUT)
        path.append((slot, level[place].children))
    return path


def _packed(path: list[tuple[int, list[str]]]) -> bytes:
    """A path in bytes: for each run its slot, its size and its digests."""
    return b"".join(bytes([slot, len(run)]) + bytes.fromhex("".join(run)) for slot, run in path)


def _unpacked(path: bytes) -> list[tuple[int, list[str]]]:
    out, at = [], 0
    while at < len(path):
        slot, size = path[at], path[at + 1]
        text = path[at + 2 : at + 2 + 32 * size].hex()
        out.append((slot, [text[64 * i : 64 * i + 64] for i in range(size)]))
        at += 2 + 32 * size
    return out


def _hex(column: Iterable) -> list[str]:
    return [value.as_py().hex() for value in column]


def _sorted(table: pa.Table) -> pa.Table:
    return table.take(np.argsort(table.column("pos").to_numpy(), kind="stable"))


def tops(nodes: DataFrame, height: int) -> DataFrame:
    """The top node of each block of ``tree, pos, n, node``, as a node of the
    tree ``height`` levels up."""
    size = FAN_OUT**height

    def run(block: pa.Table) -> pa.Table:
        block = _sorted(block)
        n = block.column("n")[0].as_py()
        found = _hex(block.column("node"))
        built = levels(found, n, height)
        top = built[-1][0].node if built else found[0]
        return pa.table(
            {
                "tree": block.column("tree").slice(0, 1),
                "pos": pa.array([block.column("pos")[0].as_py() // size]),
                "n": pa.array([-(-n // size)]),
                "node": pa.array([bytes.fromhex(top)], pa.binary()),
            }
        )

    keyed = nodes.select("tree", "pos", "n", "node", _block(height))
    return keyed.groupBy("tree", "block").applyInArrow(run, "tree string, pos long, n long, node binary")


def _block(height: int) -> Column:
    return F.shiftright("pos", 4 * height).alias("block")  # FAN_OUT is 2**4


def _paths_inside(nodes: DataFrame, height: int) -> DataFrame:
    """``tree``, ``pos``, ``block`` and each node's path to its block's top."""

    def run(block: pa.Table) -> pa.Table:
        block = _sorted(block)
        built = levels(_hex(block.column("node")), block.column("n")[0].as_py(), height)
        inside = [_packed(path_of(built, place)) for place in range(block.num_rows)]
        return block.select(["tree", "pos", "block"]).append_column("inside", pa.array(inside, pa.binary()))

    keyed = nodes.select("tree", "pos", "n", "node", _block(height))
    return keyed.groupBy("tree", "block").applyInArrow(run, "tree string, pos long, block long, inside binary")


def climbed(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """From ``tree, pos, n, node``: each node's ``path`` to its tree's last node
    (``tree, pos, path``), and these last nodes (``tree, node``)."""
    rounds = [nodes]
    while True:
        most = rounds[-1].agg(F.max("n")).first()[0] or 1
        if most == 1:
            break
        rounds.append(staged(tops(rounds[-1], height), "tops"))
    last = rounds.pop()
    paths = last.select("tree", "pos", F.lit(b"").alias("path"))
    for below in reversed(rounds):
        above = paths.select(F.col("tree").alias("_tree"), F.col("pos").alias("_block"), "path")
        inner = _paths_inside(below, height)
        here = (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block"))
        # "||" of binaries: first the runs of the block, then those above it.
        paths = inner.join(above, here).select("tree", "pos", F.concat("inside", "path").alias("path"))
        paths = staged(paths, "paths")
    return paths, last.select("tree", "node")


def _documents_of(found: pa.Table, above: pa.Table, height: int) -> pa.Table:
    """The result rows of one block of leaves, given its path to the root."""
    found = _sorted(found)
    original = _hex(found.column("leaf"))
    built = levels(original, found.column("n")[0].as_py(), height)
    subroot = above.column("subroot")[0].as_py().hex()
    root = above.column("root")[0].as_py().hex()
    # The runs above the block are hashed once, and their states serve all leaves.
    upper = [(slot, Parent(run)) for slot, run in _unpacked(above.column("path")[0].as_py())]
    tail = "".join(parent.siblings(slot) for slot, parent in upper)
    proofs, folds = [], []
    for place, (leaf, other) in enumerate(zip(original, found.column("other").to_pylist(), strict=True)):
        proof, node, at = hashlib.sha256(), leaf if other is None else other.hex(), place
        for level in built:
            at, slot = divmod(at, FAN_OUT)
            proof.update(level[at].siblings(slot).encode())
            node = level[at].folded(slot, node)
        proof.update(tail.encode())
        for slot, parent in upper:
            node = parent.folded(slot, node)
        proofs.append(proof.hexdigest())
        folds.append(node)
    n = found.num_rows
    return pa.table(
        {
            "doc_id": found.column("doc_id"),
            "leaf": pa.array(original, pa.string()),
            "subroot": pa.array([subroot] * n, pa.string()),
            "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folds, pa.string()),
            "verified": pa.array([fold == root for fold in folds], pa.bool_()),
        }
    )


def manifest(documents: DataFrame, changed: Column, height: int = HEIGHT) -> DataFrame:
    """Per row of documents its leaf, the node of its source and of all
    sources, the digest of its siblings up to there, and the root folded from
    it, where ``changed`` from its changed leaf.

    Every row is a leaf, repeated ones too: rows that share an id go by their
    leaves. Rows without an id come first in their source, and a NULL source
    before all others. A NULL ``changed`` is no change. No rows give no rows.
    Columns other than ``FIELDS`` are ignored.
    """
    hashed = staged(leaves(documents, F.coalesce(changed, F.lit(False))), "leaves")
    places = staged(placed(hashed, ["doc_id", "leaf"]), "places")
    blocks = staged(tops(places.withColumnRenamed("leaf", "node"), height), "tops")
    paths, subroots = climbed(blocks, height)
    # The sources are the leaves of one more tree, whose order is their names'.
    named = staged(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node"), "subroots")
    ranked = staged(placed(named, ["name"]), "sources")
    bottom = staged(tops(ranked, height), "tops")
    over, roots = climbed(bottom, height)
    root = roots.first()  # the one row of the one tree over sources
    sources = (
        _paths_inside(ranked, height)
        .join(over.select(F.col("pos").alias("block"), "path"), "block")
        .join(ranked.select("pos", "name", F.col("node").alias("subroot")), "pos")
        .select("name", "subroot", F.concat("inside", "path").alias("rest"))
    )
    sources = staged(sources, "source-paths")
    above = paths.join(sources, paths.tree == sources.name).select(
        "tree",
        F.col("pos").alias("block"),
        F.concat("path", "rest").alias("path"),
        "subroot",
        F.lit(bytes(root.node) if root else b"").alias("root"),
    )
    keyed = places.select("doc_id", "leaf", "other", "tree", "pos", "n", _block(height))
    return (
        keyed.groupBy("tree", "block")
        .cogroup(above.groupBy("tree", "block"))
        .applyInArrow(
            lambda found, path: _documents_of(found, path, height),
            "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
            "folded_root string, verified boolean",
        )
    )


def digests(documents: DataFrame) -> DataFrame:
    """The manifest, with every row tampered whose id's crc32 five divides."""
    return manifest(documents, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
