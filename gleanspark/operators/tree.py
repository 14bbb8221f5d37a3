"""Flattening of topic trees, given as JSON nodes or as an edge list."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions.text import span_text
from gleanspark.session import materialize

#: Tree levels opened in one plan before the remainder is looked at.
LEVELS_PER_PASS = 4


def _children(node: Column) -> Column:
    """Child nodes, null or none for a leaf; not to be used twice, as each use takes them out of the node anew."""
    return F.try_variant_get(node, "$.childNodes", "array<variant>")


def _is_open(children: Column) -> Column:
    return F.coalesce(F.size(children) > 0, F.lit(False))


def _name(node: Column) -> Column:
    return span_text(F.try_variant_get(node, "$.label", "string"), "node")


def _data_filter(node: Column) -> Column:
    return F.try_variant_get(node, "$.dataFilter", "string")


def is_leaf(node: Column | str) -> Column:
    return ~_is_open(_children(F.col(node) if isinstance(node, str) else node))


def flatten_nodes(nodes: DataFrame, node: str = "node") -> DataFrame:
    """Leaves below each row's node: ``(other columns..., name, path, depth, data_filter)``.

    Every level is an explode. ``LEVELS_PER_PASS`` levels are opened where their top
    node stands: a node, like the reply it was parsed from, is one variant of at most
    128 MiB, so it is never most of a large table. Leaves are written once, when they are
    reached; only folders that are still open are rebalanced over the tasks.
    """
    others = [c for c in nodes.columns if c != node]
    at = F.col(node)
    current = nodes.select(
        *others,
        _name(at).alias("name"),
        F.array().cast("array<string>").alias("path"),
        F.lit(1).alias("depth"),
        _data_filter(at).alias("data_filter"),
        _children(at).alias("_children"),
    )
    leaves: list[DataFrame] = []
    while True:
        for _ in range(LEVELS_PER_PASS):
            current = _open_folders(current, others)
        opened = materialize(current.withColumn("_open", _is_open(F.col("_children"))))
        # Leaves are told by a column of their own, so that they are read without the children of folders.
        leaves.append(opened.where("NOT _open").drop("_open", "_children"))
        rest = opened.where("_open").drop("_open")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, leaves)
        current = rest.hint("rebalance")


def _open_folders(current: DataFrame, others: Sequence[str]) -> DataFrame:
    """Replace every folder by its children; leaves stay as they are."""
    exploded = current.select(
        *others, "name", "path", "depth", "data_filter", F.explode_outer("_children").alias("_child")
    )
    child = F.col("_child")
    opened = child.isNotNull()
    return exploded.select(
        *others,
        F.when(opened, _name(child)).otherwise(F.col("name")).alias("name"),
        F.when(opened, F.array_append("path", F.col("name"))).otherwise(F.col("path")).alias("path"),
        F.when(opened, F.col("depth") + 1).otherwise(F.col("depth")).alias("depth"),
        F.when(opened, _data_filter(child)).otherwise(F.col("data_filter")).alias("data_filter"),
        F.when(opened, _children(child)).alias("_children"),
    )


def flatten_edges(edges: DataFrame) -> DataFrame:
    """``(node_id, title, path, depth, is_leaf)`` for an edge list ``(node_id, parent_id, title)``.

    Ancestors are found by doubling: each round joins every folder to the chain
    already known of the top it has reached, so a tree of depth d takes about
    log2(d) joins. The state is written after each round; leaves, most of the nodes
    as a rule, meet their folders once, at the end. A node whose parent is
    not in the list is a root of its own. A node has one parent: of rows that
    repeat an id the smallest ``(parent_id, title)`` counts, null first. Rows
    without id are no nodes. Nodes on or below a cycle hang below no root; they are
    the rows of :func:`tree_cycles` instead.
    """
    return _walk(edges)[0]


def tree_cycles(edges: DataFrame) -> DataFrame:
    """``(node_id, title, kind, cycle_id, cycle_size)``: the nodes of an edge list that lead into a cycle.

    ``kind`` is ``cycle`` for those on it and ``below`` for the others; ``cycle_id``
    is the smallest id on the cycle. Pointers of the folders among them are doubled
    until all stand on their cycle and have seen all of it, which takes about log2 of
    the longest cycle, or way into one, in rounds.
    """
    return _cycles(_walk(edges)[1])


def split_edges(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`flatten_edges` and those of :func:`tree_cycles`, found in one walk."""
    flat, stuck = _walk(edges)
    return flat, _cycles(stuck)


def _walk(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The flattened nodes, and ``(node_id, title, top, is_leaf)`` of those that never come to a root."""
    given = edges.where(F.col("node_id").isNotNull()).groupBy("node_id")
    edges = given.agg(F.min(F.struct("parent_id", "title")).alias("_e")).select("node_id", "_e.parent_id", "_e.title")
    parents = edges.where(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("node_id")).distinct()
    # A parent that is not in the list is no parent: its nodes are roots, with all below them.
    listed = edges.select(F.col("node_id").alias("parent_id")).withColumn("_listed", F.lit(True))
    known = edges.join(parents.withColumn("_folder", F.lit(True)), "node_id", "left").join(listed, "parent_id", "left").select(
        "node_id",
        "title",
        F.col("_folder").isNull().alias("is_leaf"),
        F.when(F.col("_listed"), F.col("parent_id")).alias("top"),
        F.array().cast("array<string>").alias("path"),
    )
    known = materialize(known)
    # Nodes hang below folders alone, so leaves wait for the chains of these.
    leaves, folders = known.where("is_leaf"), known.where("NOT is_leaf")
    # Finished nodes stay where they were written; only open ones are carried on.
    finished, still_open = folders.where(F.col("top").isNull()), folders.where(F.col("top").isNotNull())
    while not still_open.isEmpty():
        upper = finished.unionByName(still_open).select(
            F.col("node_id").alias("top"),
            F.col("top").alias("_next"),
            F.array_append("path", F.col("title")).alias("_above"),
        )
        raised = materialize(_raise(still_open, upper))
        done = raised.where(F.col("top").isNull())
        # Round n finishes all nodes of depths 2^(n-1) to 2^n, so where it finishes none, none is left below a root.
        if done.isEmpty():
            break
        finished, still_open = finished.unionByName(done), raised.where(F.col("top").isNotNull())
    above = finished.select(F.col("node_id").alias("top"), F.lit(None).cast("string").alias("_next"), F.array_append("path", F.col("title")).alias("_above"))
    hung = _raise(leaves.where(F.col("top").isNotNull()), above)
    flat = finished.unionByName(leaves.where(F.col("top").isNull())).unionByName(hung)
    flat = flat.select("node_id", "title", "path", (F.size("path") + 1).alias("depth"), "is_leaf")
    at = F.when(F.col("is_leaf"), F.col("top")).otherwise(F.col("node_id"))
    stuck = known.withColumn("_at", at).join(still_open.select(F.col("node_id").alias("_at")), "_at", "left_semi")
    return flat, stuck.select("node_id", "title", "top", "is_leaf")


def _raise(open_nodes: DataFrame, upper: DataFrame) -> DataFrame:
    return open_nodes.join(upper, "top").select(
        "node_id", "title", "is_leaf", F.col("_next").alias("top"), F.concat("_above", "path").alias("path")
    )


def _cycles(stuck: DataFrame) -> DataFrame:
    stuck = materialize(stuck)
    # `least` is the smallest of the ids passed on the way to `at`.
    reach = stuck.where("NOT is_leaf").select("node_id", F.col("top").alias("at"), F.col("node_id").alias("least"))
    reached = None
    while True:
        step = reach.select(F.col("node_id").alias("at"), F.col("at").alias("_next"), F.col("least").alias("_least"))
        less = F.col("_least") < F.col("least")
        reach = materialize(
            reach.join(step, "at").select("node_id", F.col("_next").alias("at"), F.least("least", "_least").alias("least"), less.alias("less"))
        )
        # Places reached get fewer until all are on cycles; if then no id got less, the ways have gone round them.
        before, (reached, moved) = reached, reach.agg(F.count_distinct("at"), F.max("less")).first()
        if reached == before and not moved:
            break
    on = reach.join(reach.select(F.col("at").alias("node_id")).distinct(), "node_id", "left_semi")
    on = materialize(on.select("node_id", F.col("least").alias("cycle_id")))
    sizes = on.groupBy("cycle_id").agg(F.count(F.lit(1)).alias("cycle_size"))
    ends = on.join(sizes, "cycle_id").withColumnRenamed("node_id", "at")
    placed = reach.join(ends, "at").join(on.select("node_id", F.lit(True).alias("_on")), "node_id", "left")
    placed = placed.select(F.col("node_id").alias("_at"), "_on", "cycle_id", "cycle_size")
    # A leaf leads where its folder does.
    at = F.when(F.col("is_leaf"), F.col("top")).otherwise(F.col("node_id"))
    kind = F.when(F.col("_on") & ~F.col("is_leaf"), "cycle").otherwise("below").alias("kind")
    return stuck.withColumn("_at", at).join(placed, "_at").select("node_id", "title", kind, "cycle_id", "cycle_size")
