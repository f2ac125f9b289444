"""Merkle manifest of a table, one tree for each group and one over their roots.

A row's digest is the leaf; leaves ascend by id within their group; every ``ARITY``
consecutive nodes become their parent until one is left, the group's root; the roots in
order of their groups make a tree in the same way. Only every ``STRIDE``-th level is kept
(checkpoint-and-recompute): a stored row is an aligned block of ``ARITY ** STRIDE``
neighbouring nodes. Building hashes a block to the node that stands above it and drops the
levels between; extracting proofs goes from the roots down, works out the missing levels of
each block again from its stored nodes, hands every node its siblings together with those of
the node above, and keeps none of them.

A group of any size is dealt by blocks, so a hot source is spread over all tasks. Positions
come from one global sort of the leaves (digests and ids only); rows alike in group, id and
digest are told apart by the place they were staged at, so that a hot id can be split too.

Defined cases: null values count as ``-``; a null group is a group and comes first; null ids
come first in their group; rows of equal id ascend by digest; a null id is tampered with (its
decimal text is empty, its checksum 0); a single leaf is its group's root; an empty table has
no rows; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.llm.common import remainder, staged

ARITY = 3
STRIDE = 3
BLOCK = ARITY**STRIDE
#: Up to so many rows of a table of positions or roots are broadcast.
BROADCAST_ROWS = 200_000
_HEIGHTS = 39


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def _parents(nodes: Column) -> Column:
    """The digests of every ARITY neighbours."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int")),
        lambda r: digest(F.concat_ws("", F.slice(nodes, r * ARITY + 1, ARITY))),
    )


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    return reduce(lambda a, b: a + b, [(n > ARITY**i).cast("int") for i in range(_HEIGHTS)])


def _beside(big: DataFrame, small: DataFrame, on: list[str] | Column) -> DataFrame:
    """Join with a staged table, which is broadcast if it has few rows."""
    few = small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return big.join(F.broadcast(small) if few else small, on)


def numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows in global order with ``part`` and ``at``, and (group, part, first, before, n).

    ``at - first + before`` is a row's position in its group of ``n``. Both are staged.
    """
    ascending = [F.asc_nulls_first(c) for c in [group, *order]]
    # the identifier carries the partition in its upper bits, partitions are in order
    at = F.monotonically_increasing_id()
    in_order = staged(rows.orderBy(*ascending).select("*", at.alias("at")), "merkle-sorted", 0)
    in_order = in_order.withColumn("part", F.shiftright("at", 33))
    runs = in_order.groupBy(group, "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("at").alias("first")
    )
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group,
        "part",
        "first",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(whole).alias("n"),
    )
    return in_order, staged(runs, "merkle-runs")


@dataclass
class Forest:
    """Trees by number: ``levels[k]`` holds the blocks of level ``STRIDE * k``."""

    levels: list[DataFrame]
    roots: DataFrame


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """(tree, block, h, nodes): neighbouring nodes in order, at most BLOCK in a row."""
    keyed = nodes.withColumn("block", F.expr(f"pos div {BLOCK}L"))
    kept = [c for c in nodes.columns if c not in ("tree", "h")]
    gathered = F.sort_array(F.collect_list(F.struct("pos", *[c for c in kept if c != "pos"])))
    return staged(
        keyed.groupBy("tree", "block", "h").agg(gathered.alias("nodes")), f"merkle-{name}"
    )


def _missing(blocks: DataFrame, level: int) -> DataFrame:
    """Adds ``l0`` to ``l<STRIDE>``, the levels of the block, and ``steps``, those that exist."""
    out = blocks.withColumn("steps", F.least(F.lit(STRIDE), F.col("h") - STRIDE * level))
    out = out.withColumn("l0", F.transform("nodes", lambda x: x["digest"]))
    for i in range(STRIDE):
        above = F.when(F.col("steps") > i, _parents(F.col(f"l{i}")))
        out = out.withColumn(f"l{i + 1}", above)
    return out


def build(leaves: DataFrame) -> Forest:
    """The stored levels and the roots of (tree, pos, n, digest, other columns)."""
    nodes = leaves.withColumn("h", _height(F.col("n"))).drop("n")
    levels = [_blocks(nodes, "leaves")]
    tallest = levels[0].agg(F.max("h")).first()[0] or 0
    for k in range(-(-tallest // STRIDE)):
        growing = _missing(levels[k].where(F.col("h") > STRIDE * k), k)
        top = F.coalesce(*[F.col(f"l{i}")[0] for i in range(STRIDE, 0, -1)])
        up = growing.select("tree", F.col("block").alias("pos"), "h", top.alias("digest"))
        levels.append(_blocks(up, f"level{k + 1}"))
    root = F.col("nodes")[0]["digest"].alias("digest")
    roots = [_ended(blocks, k).select("tree", root) for k, blocks in enumerate(levels)]
    return Forest(levels, reduce(DataFrame.unionAll, roots))


def _ended(blocks: DataFrame, level: int) -> DataFrame:
    """Blocks of one node, the root of its tree, in the level that reaches its height first."""
    return blocks.where((F.col("h") <= STRIDE * level) & (F.col("h") > STRIDE * (level - 1)))


def _siblings(level: int, i: Column) -> Column:
    """(left, right) of node i's ancestor ``level`` levels up, within its block."""
    nodes = F.col(f"l{level}")
    own = F.floor(i / ARITY**level).cast("int")
    start = F.floor(own / ARITY).cast("int") * ARITY
    left = F.concat_ws("", F.slice(nodes, start + 1, own - start))
    right = F.concat_ws("", F.slice(nodes, own + 2, start + ARITY - 1 - own))
    return F.struct(left.alias("left"), right.alias("right"))


def _local(i: Column) -> Column:
    """The siblings of node i within its block, level by level."""
    return F.slice(F.array(*[_siblings(j, i) for j in range(STRIDE)]), F.lit(1), F.col("steps"))


def with_paths(forest: Forest, tops: DataFrame) -> DataFrame:
    """The leaves with ``path``, the siblings of each level from the leaf to the root.

    ``tops``: tree, path (what follows above the tree's root) and any columns to hand down.
    """
    down = [c for c in tops.columns if c != "tree"]
    found = None
    for k in range(len(forest.levels) - 1, -1, -1):
        ended = _ended(forest.levels[k], k).join(tops, "tree")
        here = ended.select("tree", F.col("nodes")[0].alias("node"), *down)
        if found is not None:
            above = found.select("tree", F.col("node.pos").alias("block"), *down)
            blocks = forest.levels[k].where(F.col("h") > STRIDE * k)
            joined = _missing(blocks, k).join(above, ["tree", "block"])
            each = F.transform("nodes", lambda node, i: F.struct(node.alias("node"), _local(i).alias("path")))
            one = joined.select("tree", F.explode(each).alias("one"), *down)
            path = F.concat(F.col("one.path"), F.col("path")).alias("path")
            rest = [c for c in down if c != "path"]
            children = one.select("tree", F.col("one.node").alias("node"), path, *rest)
            here = here.select(*children.columns).unionAll(children)
        found = here
    return found


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(
        path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"]))
    )


def proof_digest(path: Column) -> Column:
    return digest(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))))


def manifest(leaves: DataFrame) -> DataFrame:
    """(node, path, subroot, root) of rows (grp, id, digest, other columns).

    ``node`` holds a leaf's position, digest and other columns; ``path`` its proof.
    """
    rows = staged(leaves.withColumn("uid", F.monotonically_increasing_id()), "merkle-rows")
    in_order, runs = numbered(rows, "grp", ["id", "digest", "uid"])
    groups = runs.select("grp").distinct().withColumn("all", F.lit(0))
    groups, where = numbered(groups, "all", ["grp"])
    position = (F.col("at") - F.col("first") + F.col("before")).alias("pos")
    trees = _beside(groups, where, ["all", "part"]).select("grp", position.alias("tree"))
    runs = runs.alias("r").join(trees.alias("t"), F.expr("r.grp <=> t.grp"))
    runs = staged(runs.select("r.*", "t.tree").withColumnRenamed("grp", "of"), "merkle-runs")
    rest = [c for c in leaves.columns if c not in ("grp", "id", "digest")]
    same = F.col("grp").eqNullSafe(F.col("of")) & F.col("l.part").eqNullSafe(F.col("r.part"))
    placed = _beside(in_order.alias("l"), runs.alias("r"), same)
    forest = build(placed.select("tree", position, "n", "digest", "id", *rest))

    subroots = staged(forest.roots, "merkle-subroots")
    count = subroots.count()
    top = build(
        subroots.select(
            F.lit(0).cast("long").alias("tree"),
            F.col("tree").alias("pos"),
            F.lit(count).cast("long").alias("n"),
            "digest",
        )
    )
    empty = F.array().cast("array<struct<left:string,right:string>>")
    root = top.roots.select("tree", F.col("digest").alias("root"), empty.alias("path"))
    tops = with_paths(top, root).select(
        F.col("node.pos").alias("tree"), F.col("node.digest").alias("subroot"), "root", "path"
    )
    return with_paths(forest, staged(tops, "merkle-tops"))


def document_manifest(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of each document, and what a changed text does to them."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    tampered = F.when(
        (remainder(F.col("doc_id"), 2) == 0) & F.contains(F.col("text"), F.lit("\n")),
        leaf_digest(*columns, changed),
    )
    leaves = docs.select(
        F.col("source").alias("grp"),
        F.col("doc_id").alias("id"),
        leaf_digest(*columns, F.col("text")).alias("digest"),
        tampered.alias("tampered"),
    )
    proofs = manifest(leaves)
    leaf = F.col("node.digest")
    folded = fold(F.coalesce(F.col("node.tampered"), leaf), F.col("path"))
    out = proofs.select(
        F.col("node.id").alias("doc_id"),
        leaf.alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
