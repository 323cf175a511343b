"""A Merkle manifest of a table: content-addressed records, and proofs by descent from the root.

A row's leaf is the SHA-256 of its values. In each group (a language) leaves ascend by id; every ``ARITY`` consecutive nodes
become their hash until one is left, the group's subroot. Subroots in the order of groups become the root in the same way.

Records. Each inner node is stored under its digest, with the digests of its children in order; equal subtrees are one
record. Records are kept level by level.

Proofs. A request is a leaf's number in its group. Its digits to the base ``ARITY`` say which child to take on the way down
from the root. Requests that share leading digits go down together, so a level's join has one row for each node that is
asked for, and the rows at the root are few though all leaves descend from it. At each step the children that were not taken are
collected. The way read backwards is the proof: siblings from the leaf's level up to the root.

Every step is a DataFrame operation: leaves are numbered by ranges with prefix sums, so no group meets in one task, and what
is gathered in a row is at most ``ARITY`` digests for each level.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartier.operators.numbering import numbered
from quartier.session import cut_lineage

ARITY = 8
_PATH = "array<struct<index:int,siblings:array<string>>>"


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of texts, one after the other."""
    return F.sha2(F.concat(*values), 256)


def framed(value: Column) -> Column:
    """A value so that no two rows run together: ``-`` for null, else its length in UTF-8 bytes, ``:``, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    return digest(*(framed(v) for v in values))


def depth(n: int) -> int:
    """Levels above the leaves until one node is left."""
    levels, width = 0, 1
    while width < n:
        levels, width = levels + 1, width * ARITY
    return levels


@dataclass(frozen=True)
class Tree:
    """Trees over the groups of numbered nodes: ``records[j]`` holds the nodes of level j + 1, ``tops`` each group's root."""

    records: list[DataFrame]  # (digest, children)
    tops: DataFrame  # (group, top, depth)


@dataclass(frozen=True)
class Manifest:
    leaves: DataFrame  # (group, position, leaf, further columns)
    groups: Tree
    root_tree: Tree
    order: DataFrame  # (group, position): groups numbered in their order
    root: str | None


def _tree(nodes: DataFrame, most: int) -> Tree:
    """Hash upwards the ``nodes`` (group, position, digest, n), n of them in their group and ``most`` in the largest."""
    records, tops = [], []
    for level in range(depth(most) + 1):
        tops.append(nodes.where("n = 1").select("group", F.col("digest").alias("top"), F.lit(level).alias("depth")))
        if level == depth(most):
            break
        child = F.struct("position", "digest")
        runs = nodes.where("n > 1").groupBy("group", F.expr(f"position div {ARITY}").alias("position"), "n")
        made = runs.agg(F.sort_array(F.collect_list(child))["digest"].alias("children"))
        made = cut_lineage(made.withColumn("digest", F.sha2(F.concat_ws("", "children"), 256)))
        records.append(cut_lineage(made.groupBy("digest").agg(F.min("children").alias("children"))))
        nodes = made.select("group", "position", "digest", F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"))
    joined = tops[0]
    for more in tops[1:]:
        joined = joined.union(more)
    return Tree(records, cut_lineage(joined))


def build(
    rows: DataFrame, leaf: Column, by: str = "lang", order: str = "doc_id", keep: Mapping[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``rows``, which are read once; ``keep`` names further columns of the kept leaves.

    Groups come in bytewise order, the null group first. Within a group a null id comes first; rows of one id are ordered by
    their leaves, so that the manifest depends on the rows alone; repeated rows have a leaf each. An empty table has no root.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit(""))  # in the same order, never null
    first = rows.select(group.alias("group"), F.col(order).alias("_order"), leaf.alias("leaf"), *(
        column.alias(name) for name, column in (keep or {}).items()
    ))
    leaves = numbered(cut_lineage(first), [F.col("_order"), F.col("leaf")], ["group"]).drop("_order")
    leaves = cut_lineage(leaves)
    sizes = cut_lineage(leaves.groupBy("group").agg(F.count(F.lit(1)).alias("n")))
    groups, most = sizes.agg(F.count(F.lit(1)), F.max("n")).first()
    nodes = leaves.select("group", "position", F.col("leaf").alias("digest")).join(sizes, "group")
    trees = _tree(nodes, most or 1)
    ordered = cut_lineage(numbered(trees.tops, [F.col("group")]).select("group", "position"))
    subroots = ordered.join(trees.tops, "group").select(
        F.lit("").alias("group"), "position", F.col("top").alias("digest"), F.lit(groups).cast("long").alias("n")
    )
    whole = _tree(subroots, groups or 1)
    found = whole.tops.first()
    return Manifest(leaves, trees, whole, ordered, found["top"] if found else None)


def _others(index: Column, children: Column) -> Column:
    """A step of a path: the place that was taken, and the children that were not."""
    siblings = F.concat(F.slice(children, 1, index), F.slice(children, index + 2, F.lit(ARITY)))
    return F.array(F.struct(index.cast("int").alias("index"), siblings.alias("siblings")))


def _descend(start: DataFrame, tree: Tree, wanted: DataFrame | None, until: int) -> DataFrame:
    """Nodes of level ``until`` below the tops ``start`` (group, digest, depth, path, more): as (..., position, path).

    With ``wanted`` (group, position) only nodes above these leaves are gone through.
    """
    start = start.withColumn("position", F.lit(0).cast("long"))
    frontier = None
    for level in range(len(tree.records), until, -1):
        here = start.where(F.col("depth") == level)
        here = here if frontier is None else here.union(frontier)
        columns = here.columns
        taken = here.join(tree.records[level - 1], "digest").select(
            *(c for c in here.columns if c != "digest"), "children", F.posexplode("children").alias("_index", "digest")
        )
        taken = taken.withColumn("path", F.concat("path", _others(F.col("_index"), F.col("children"))))
        frontier = taken.withColumn("position", F.col("position") * ARITY + F.col("_index")).select(*columns)
        if wanted is not None:
            above = F.expr(f"position div {ARITY ** (level - 1)}").alias("position")
            asked = wanted.select("group", above).distinct()
            frontier = frontier.join(asked, ["group", "position"], "left_semi").select(*columns)
    here = start.where(F.col("depth") == until)
    return here if frontier is None else here.union(frontier)


def proofs(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """The leaves with ``subroot`` and ``path``: for each level from the leaf's up to the root's, (index, siblings).

    ``index`` is the place of the leaf's own node among its siblings. With ``wanted`` (group, position) only these leaves.
    """
    spark = manifest.leaves.sparkSession
    if manifest.root is None:
        empty = manifest.leaves.withColumn("subroot", F.lit(None).cast("string"))
        return empty.withColumn("path", F.lit(None).cast(_PATH))
    leaves = manifest.leaves
    if wanted is not None:
        wanted = cut_lineage(wanted.select("group", "position").distinct())
        leaves = leaves.join(wanted, ["group", "position"], "left_semi")
    top = spark.createDataFrame([("", manifest.root, len(manifest.root_tree.records))], "group string, digest string, depth int")
    of_groups = None if wanted is None else manifest.order.join(wanted.select("group").distinct(), "group", "left_semi")
    of_groups = of_groups if of_groups is None else of_groups.select(F.lit("").alias("group"), "position")
    ends = _descend(top.withColumn("path", F.array().cast(_PATH)), manifest.root_tree, of_groups, 0).select("position", "path")
    start = manifest.groups.tops.join(manifest.order.join(ends, "position").drop("position"), "group")
    start = cut_lineage(start.select("group", F.col("top").alias("digest"), "depth", "path", F.col("top").alias("subroot")))
    # The last step joins parents with the rows of their leaves, so whole paths move once for each parent.
    parents = _descend(start.where("depth > 0"), manifest.groups, wanted, 1)
    if manifest.groups.records:
        parents = parents.join(manifest.groups.records[0], "digest").select(
            "group", F.col("position").alias("_parent"), "subroot", "path", "children"
        )
        below = leaves.withColumn("_parent", F.expr(f"position div {ARITY}")).join(parents, ["group", "_parent"])
        step = _others((F.col("position") % ARITY).cast("int"), F.col("children"))
        below = below.withColumn("path", F.concat("path", step)).drop("_parent", "children")
    alone = leaves.where("position = 0").join(start.where("depth = 0").select("group", "subroot", "path"), "group")
    found = below.unionByName(alone) if manifest.groups.records else alone
    return found.withColumn("path", F.reverse("path"))


def siblings(path: Column) -> Column:
    """All siblings of a proof as one text, level by level, left to right."""
    return F.concat_ws("", F.flatten(F.transform(path, lambda step: step["siblings"])))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof give."""

    def up(node: Column, step: Column) -> Column:
        left = F.concat_ws("", F.slice(step["siblings"], 1, step["index"]))
        return digest(left, node, F.concat_ws("", F.slice(step["siblings"], step["index"] + 1, F.lit(ARITY))))

    return F.aggregate(path, leaf, up)
