"""A Merkle manifest of a dataset whose parents keep the hash states of their children's slots.

A leaf is a digest of a row's fields.  Leaves of one tree, in order, are hashed eight at a
time into parents until one node, the subroot, remains; subroots of all trees are hashed
likewise into the root.  A parent copies the running SHA-256 state before it takes each
child.  To fold a changed child, the copy at its slot resumes with the replacement and the
siblings on its right; what lies on the left is never hashed again.

Trees are cut into runs of ``RUN`` nodes, whole subtrees of ``DEPTH`` levels.  A run is one
group of short rows: it sends its top node upwards, and on the way down takes the path from
that top to the root and hands every node its own path.  No group holds more than ``RUN``
nodes and one path, so a tree of any size takes log(n) / log(RUN) rounds.  Positions come
from a range partitioning whose parts are counted.  Texts are hashed where they are read
and never travel.

Defined results: null fields are hashed as ``-``; null keys of trees and rows come first;
rows of one id are ordered by their digest; repeated rows are leaves each; an empty table
has no leaves, trees or root; columns other than the hashed ones are not read.
"""

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellshift.session import stored

ARITY = 8
DEPTH = 3
RUN = ARITY**DEPTH
DIGITS = 64  # of a digest in hex
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = "top"
_NODES = "tree string, at long, n long, digest string"


# --- hashing -----------------------------------------------------------------


class Parent:
    """The digest of a run of children, with the state it had before each of them."""

    def __init__(self, children: Sequence[str]):
        self.children = children
        self.before = []
        state = hashlib.sha256()
        for child in children:
            self.before.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def folded(self, slot: int, replacement: str) -> str:
        """The digest with another child in one slot: resumed there, the left is not hashed again."""
        state = self.before[slot].copy()
        state.update(replacement.encode())
        for child in self.children[slot + 1 :]:
            state.update(child.encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> str:
        return "".join(child for i, child in enumerate(self.children) if i != slot)


def parents_of(nodes: Sequence[str]) -> list[Parent]:
    return [Parent(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def fold(leaf: str, proof: Sequence[str]) -> str:
    """The root that a leaf and its proof give: each level is the slot's digit and the siblings."""
    for level in proof:
        slot, rest = int(level[0]), level[1:]
        cut = slot * DIGITS
        leaf = hashlib.sha256((rest[:cut] + leaf + rest[cut:]).encode()).hexdigest()
    return leaf


def _subtree(nodes: Sequence[str], n: int) -> list[list[Parent]]:
    """The parents above a run's nodes, level by level, where the tree has ``n`` nodes at that height."""
    levels = []
    for _ in range(min(DEPTH, height(n))):
        levels.append(parents_of(nodes))
        nodes = [parent.digest for parent in levels[-1]]
    return levels


def field_bytes(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_bytes(field) for field in fields]), 256)


# --- order -------------------------------------------------------------------


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``at``, the place of each row in its ``tree`` from 0, and ``n``, the tree's rows.

    ``nodes`` is a stored table and ``order`` decides between any two of its rows.  Rows are
    dealt by ranges of (tree, order), numbered inside a part, and parts start after the rows
    counted in the parts before.
    """
    ranged = nodes.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy("tree", "part").orderBy(*order)
    placed = stored(ranged.withColumn("inside", F.row_number().over(inside) - 1), "merkle-order")
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("tree", "part")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "tree", "part",
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"),
            F.sum("rows").over(whole).alias("n"),
        )
    )
    joined = placed.join(starts, ["tree", "part"])
    return joined.withColumn("at", F.col("start") + F.col("inside")).drop("part", "inside", "start")


# --- up and down -------------------------------------------------------------


def _in_runs(nodes: DataFrame) -> DataFrame:
    return nodes.select("tree", F.floor(F.col("at") / RUN).cast("long").alias("run"), "at", "n", "digest")


def _top_of_run(table: pa.Table) -> pa.Table:
    rows = table.sort_by("at").to_pydict()
    n = rows["n"][0]
    levels = _subtree(rows["digest"], n)
    top = levels[-1][0].digest if levels else rows["digest"][0]
    for _ in levels:
        n = -(-n // ARITY)
    return pa.table(
        {"tree": rows["tree"][:1], "at": rows["run"][:1], "n": [n], "digest": [top]},
        pa.schema([("tree", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]),
    )


def climbed(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Stored tables of nodes, one a round, from ``nodes`` (tree, at, n, digest) to one node a tree."""
    rounds = [nodes.select("tree", "at", "n", "digest")]
    most = nodes.agg(F.max("n")).first()[0] or 0  # one number
    for _ in range(-(-height(most) // DEPTH)):
        tops = _in_runs(rounds[-1]).groupBy("tree", "run").applyInArrow(_top_of_run, _NODES)
        rounds.append(stored(tops, label))
    return rounds


def _paths(own: Sequence[Sequence[Parent]], i: int) -> list[str]:
    """The levels of a proof that lie inside the run of node ``i``."""
    path = []
    for level in own:
        parent, slot = level[i // ARITY], i % ARITY
        path.append(f"{slot}{parent.siblings(slot)}")
        i //= ARITY
    return path


def _handed_down(key, nodes: pa.Table, above: pa.Table) -> pa.Table:
    rows = nodes.sort_by("at").to_pydict()
    upper = above["path"][0].as_py()
    levels = _subtree(rows["digest"], rows["n"][0]) if rows["n"] else []
    size = len(rows["at"])
    return pa.table(
        {
            "tree": pa.array(rows["tree"], pa.string()),
            "at": pa.array(rows["at"], pa.int64()),
            "path": pa.array([_paths(levels, i) + upper for i in range(size)], pa.list_(pa.string())),
        }
    )


def descended(rounds: Sequence[DataFrame], paths: DataFrame, lowest: int, label: str) -> DataFrame:
    """tree, at, path of the nodes of round ``lowest``; ``paths`` has those of the last round."""
    for nodes in reversed(rounds[lowest:-1]):
        above = paths.select("tree", F.col("at").alias("run"), "path")
        down = (
            _in_runs(nodes)
            .groupBy("tree", "run")
            .cogroup(above.groupBy("tree", "run"))
            .applyInArrow(_handed_down, "tree string, at long, path array<string>")
        )
        paths = stored(down, label)
    return paths


# --- manifest ----------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """Built trees, as stored tables."""

    leaves: DataFrame  # tree, at, n, digest, and what came with the leaves
    rounds: list[DataFrame]  # tree, at, n, digest: the leaves, then the tops of runs, round by round
    subroots: DataFrame  # tree, subroot, root, path from the subroot to the root


def built(leaves: DataFrame, order: Sequence[str]) -> Manifest:
    """The manifest of ``leaves``: tree, digest, the columns of ``order`` and any others.

    ``tree`` is not null; trees stand in the order of their names, byte by byte.
    """
    # equal rows are told apart by their place in the stored table
    listed = stored(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = stored(numbered(listed, [*order, "digest", "row"]).drop("row"), "merkle-placed")
    rounds = climbed(placed, "merkle-nodes")
    tops = rounds[-1].select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), "digest")
    tops = stored(numbered(stored(tops, "merkle-tops"), ["name"]), "merkle-subroots")
    above = climbed(tops, "merkle-above")
    at_root = above[-1].select("tree", "at", F.array().cast("array<string>").alias("path"))
    paths = descended(above, at_root, 0, "merkle-down")
    root = above[-1].select("tree", F.col("digest").alias("root"))
    subroots = (
        tops.join(root, "tree")
        .join(paths, ["tree", "at"])
        .select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    )
    return Manifest(placed, rounds, stored(subroots, "merkle-roots"))


def audited(manifest: Manifest) -> DataFrame:
    """The leaves with ``proof, subroot, root, folded_root``.

    The leaves hold ``replacement``, the digest to put in a leaf's place.  ``proof`` has a
    text a level, from the leaf to the root: the digit of the slot, then the siblings from
    left to right; ``fold`` recomputes the root from it.  ``folded_root`` takes each
    replacement alone, with all other leaves as they were.
    """
    ends = manifest.subroots.select("tree", F.lit(0).cast("long").alias("at"), "path")
    paths = descended(manifest.rounds, ends, 1, "merkle-paths")
    above = paths.join(manifest.subroots.drop("path"), "tree").select(
        "tree", F.col("at").alias("run"), "path", "subroot", "root"
    )
    leaves = manifest.leaves.withColumn("run", F.floor(F.col("at") / RUN).cast("long"))
    out = f"{leaves.drop('run').schema.simpleString()[7:-1]},proof:array<string>,subroot:string,root:string,folded_root:string"
    return leaves.groupBy("tree", "run").cogroup(above.groupBy("tree", "run")).applyInArrow(_audited_run, out)


def _audited_run(key, leaves: pa.Table, above: pa.Table) -> pa.Table:
    leaves = leaves.sort_by("at").drop_columns("run")
    if not leaves.num_rows:
        return _with_audit(leaves, [], [], [], [])
    path, subroot, root = (above[name][0].as_py() for name in ("path", "subroot", "root"))
    digests, replacements = leaves["digest"].to_pylist(), leaves["replacement"].to_pylist()
    levels = _subtree(digests, leaves["n"][0].as_py())
    top = levels[-1][0].digest if levels else digests[0]
    upper = []
    for level in path:
        slot, rest = int(level[0]), level[1:]
        children = [rest[i : i + DIGITS] for i in range(0, len(rest), DIGITS)]
        children.insert(slot, top)
        parent = Parent(children)
        upper.append((parent, slot))
        top = parent.digest
    above_top = {}  # roots by the run's top: what leaves of one run share
    folded = []
    for i, digest in enumerate(replacements):
        for level in levels:
            digest, i = level[i // ARITY].folded(i % ARITY, digest), i // ARITY
        if digest not in above_top:
            end = digest
            for parent, slot in upper:
                end = parent.folded(slot, end)
            above_top[digest] = end
        folded.append(above_top[digest])
    size = len(digests)
    proofs = [_paths(levels, i) + path for i in range(size)]
    return _with_audit(leaves, proofs, [subroot] * size, [root] * size, folded)


def _with_audit(leaves: pa.Table, proofs, subroots, roots, folded) -> pa.Table:
    leaves = leaves.append_column("proof", pa.array(proofs, pa.list_(pa.string())))
    for name, values in (("subroot", subroots), ("root", roots), ("folded_root", folded)):
        leaves = leaves.append_column(name, pa.array(values, pa.string()))
    return leaves


def document_leaves(
    docs: DataFrame, tampered: Column | None = None, fields: Sequence[str] = FIELDS, tree: str = "lang"
) -> DataFrame:
    """tree, doc_id, digest, replacement of documents; ``tampered`` is the text to put in, null for none."""
    name = F.when(F.col(tree).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(tree).cast("string")))
    digest = leaf_digest([F.col(field) for field in fields])
    replacement = digest
    if tampered is not None:
        changed = leaf_digest([tampered if field == "text" else F.col(field) for field in fields])
        replacement = F.when(tampered.isNotNull(), changed).otherwise(digest)
    return docs.select(name.alias("tree"), "doc_id", digest.alias("digest"), replacement.alias("replacement"))
