"""Parent-pointer hierarchies of any depth, flattened by pointer doubling.

A self-join per level needs as many joins as the tree is deep, and a depth known beforehand.  Here
every node points to an ancestor and takes over that ancestor's pointer, so the distance doubles with
each round: a tree of depth d is done after log2(d) rounds.  Pointers that still move after as many
rounds as the number of nodes allows run in a cycle.  Paths are built the same way afterwards, for
nodes that hang below a top only, since the path of a cycle never ends.

Every round is written to the shared folder, so lineage stays short.  A parent that many nodes point
to (in the last rounds, the tops) is a hot key of the join and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.joins import join_by_share
from tidewater.sources.results import scratch

OK, ORPHAN, CYCLE = "ok", "orphan", "cycle"


def _follow(live: DataFrame, pointer: str, target: DataFrame) -> DataFrame:
    """Rows with the columns of the target row (key ``t_id``) their pointer shows."""
    asked = live.groupBy(F.col(pointer).alias("t_id")).agg(F.count(F.lit(1)).alias("t_n"))
    side = target.join(asked, "t_id").withColumnRenamed("t_id", pointer)
    return join_by_share(live, side, [pointer], "t_n").drop("t_n")


def _tops(edges: DataFrame) -> DataFrame:
    """(id, parent, top, depth, status) for edges (id, parent): the top above each node."""
    known = edges.filter("parent is not null").join(edges.select(F.col("id").alias("parent")), "parent", "left_semi") \
        .select("id", F.lit(True).alias("has_parent"))
    state = edges.join(known, "id", "left").select(
        "id", "parent", F.when(F.col("has_parent"), F.col("parent")).otherwise(F.col("id")).alias("top"),
        F.when(F.col("has_parent"), 1).otherwise(0).cast("bigint").alias("depth"), F.coalesce("has_parent", F.lit(False)).alias("live"),
        F.when(F.col("parent").isNotNull() & F.col("has_parent").isNull(), ORPHAN).otherwise(OK).alias("status"))
    state = scratch(state, "hierarchy-tops")
    reach, nodes = 1, state.count()
    while reach <= nodes and not state.filter("live").isEmpty():
        target = state.select(F.col("id").alias("t_id"), F.col("top").alias("t_top"), F.col("depth").alias("t_depth"),
                              F.col("live").alias("t_live"), F.col("status").alias("t_status"))
        moved = _follow(state.filter("live"), "top", target).select(
            "id", "parent", F.col("t_top").alias("top"), (F.col("depth") + F.col("t_depth")).alias("depth"), F.col("t_live").alias("live"),
            F.col("t_status").alias("status"))
        state, reach = scratch(state.filter("not live").unionByName(moved), "hierarchy-tops"), reach * 2

    def settled(c: str) -> Column:
        return F.when(~F.col("live"), F.col(c)).alias(c)

    return state.select("id", "parent", settled("top"), settled("depth"), F.when(F.col("live"), CYCLE).otherwise(F.col("status")).alias("status"))


def _paths(tops: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, path): structs (id, label) from the top down to each node that is in no cycle."""
    up = F.when(F.col("top") != F.col("id"), F.col("parent")).alias("up")
    state = scratch(tops.filter(F.col("status") != CYCLE).join(labels, "id").select(
        "id", up, F.array(F.struct("id", "label")).alias("path")), "hierarchy-paths")
    while not state.filter("up is not null").isEmpty():
        target = state.select(F.col("id").alias("t_id"), F.col("up").alias("t_up"), F.col("path").alias("t_path"))
        moved = _follow(state.filter("up is not null"), "up", target).select(
            "id", F.col("t_up").alias("up"), F.concat("t_path", "path").alias("path"))
        state = scratch(state.filter("up is null").unionByName(moved), "hierarchy-paths")
    return state.select("id", "path")


def flatten_hierarchy(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id", label_col: str | None = None) -> DataFrame:
    """One row per node: its id and parent, ``root_id``, ``depth`` (0 at the top), ``status``, ``path`` (ids from
    the top to the node) and, with ``label_col``, ``labels`` (their texts).

    ``status`` is 'ok' below a node without a parent, 'orphan' below one whose parent is not among the
    nodes, and 'cycle' in or below a cycle, where root, depth and path are NULL.  A node is known by its
    id: rows without one are left out, and of rows that repeat one the smallest parent and label count.
    """
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    one = nodes.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(F.col(parent_col).cast(nodes.schema[id_col].dataType)).alias("parent"), F.min(label).alias("label"))
    one = scratch(one, "hierarchy-nodes")
    tops = scratch(_tops(one.select("id", "parent")), "hierarchy-settled")
    paths = _paths(tops, one.select("id", "label"))
    out = tops.join(paths, "id", "left").select(
        F.col("id").alias(id_col), F.col("parent").alias(parent_col), F.col("top").alias("root_id"), "depth", "status",
        F.col("path")["id"].alias("path"), F.col("path")["label"].alias("labels"))
    return out if label_col else out.drop("labels")
