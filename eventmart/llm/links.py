"""Links between members of the same buckets, and the components they make.

A bucket may hold any number of members, so no list of all its pairs is ever made:

* `star_pairs` pairs every member with the smallest of its bucket, and in large ones with a few others.
* Once those pairs are confirmed and joined into components, most buckets lie inside one component and need nothing more.
* Small buckets, if asked for, give all their pairs at first: a bounded number each.
* The members of the others are joined by `prefix_pairs`, which finds every pair of similar sets in different components by
  their rarest elements. Copies that differ from each other by more than the limit meet there in few pairs or none.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.tables import ROWS_PER_TASK, settle, written

BROADCAST_ROWS = 50_000  # edges of a round up to which Spark may broadcast its joins; several rounds' ones are held at once


def linked(members: DataFrame, confirm: Callable[[DataFrame], DataFrame], elements: Callable[[DataFrame], DataFrame] | None,
           percent: int, rows: int, known: DataFrame | None = None, met: bool = False, small: int = 0,
           centres: int = 1, prefixes: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """node, component (the smallest node reachable) of the nodes that have links.

    members: bucket long, node long. confirm gets pairs a < b and returns those that are links. elements gets nodes and
    returns the elements of their sets: node, element. rows: about how many nodes there are. known: further links a, b.
    met: members holds buckets of several nodes only. small: buckets of so many members give their pairs.
    centres: so many members of a larger bucket are paired with all others at once. prefixes: instead of elements, gets nodes and
    returns the first elements of their sets: node, element, pos, size (see `prefix_pairs`).
    """
    members = members if met else settle(meeting(members), rows)
    pairs = star_pairs(members, centres, small)
    edges = confirm(pairs.union(small_pairs(members, small)).distinct() if small else pairs)
    component = components(edges if known is None else edges.union(known), rows)
    open_nodes = settle(undecided(members, component, max(2, small)), rows)
    if not open_nodes.isEmpty():
        asked = open_nodes.select("node")
        new = confirm(prefix_pairs(open_nodes, elements(asked), percent, rows) if prefixes is None
                      else pairs_by_prefix(settle(prefixes(asked).join(open_nodes, "node"), 8 * rows), percent))
        if not new.isEmpty():
            component = components(component.select(F.col("component").alias("a"), F.col("node").alias("b")).union(new), rows)
    return component


def meeting(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one node."""
    buckets = (members.groupBy("bucket").agg(F.min("node").alias("_first"), F.max("node").alias("_last"))
               .where("_first < _last").select("bucket"))
    return members.join(buckets, "bucket").select("bucket", "node")


def star_pairs(members: DataFrame, centres: int = 1, small: int = 0) -> DataFrame:
    """Distinct pairs a < b of the smallest node of a bucket and each other one.

    Of a bucket with more than `small` members, so many centres are paired with the others, in an order of nodes for each.
    """
    if centres == 1:
        buckets = members.groupBy("bucket").agg(F.min("node").alias("a"))
        return (members.join(buckets, "bucket").where("node > a")
                .select("a", F.col("node").alias("b")).distinct())
    order = random.Random(20240116)
    masks = [0] + [order.getrandbits(62) for _ in range(centres - 1)]
    chosen = [F.min(F.col("node").bitwiseXOR(F.lit(m).cast("long"))).bitwiseXOR(F.lit(m).cast("long")) for m in masks]
    of_all = F.when(F.count(F.lit(1)) > small, F.array(*chosen)).otherwise(F.array(chosen[0]))
    buckets = members.groupBy("bucket").agg(of_all.alias("centres"))
    return (members.join(buckets, "bucket").select("node", F.explode("centres").alias("centre")).where("node <> centre")
            .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())


def small_pairs(members: DataFrame, small: int) -> DataFrame:
    """Pairs a < b, without the smallest node, of the buckets with 3 to `small` members."""
    packed = (members.groupBy("bucket").agg(F.min("node").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n").between(3, small)).join(members, "bucket").where("node > _first")
              .groupBy("bucket").agg(F.collect_list("node").alias("of")))
    return packed.select(F.explode("of").alias("a"), "of").select("a", F.explode("of").alias("b")).where("a < b")


def undecided(members: DataFrame, component: DataFrame, looked_at: int = 2) -> DataFrame:
    """node, component of the members of buckets that may hold a pair nobody has looked at, in different components.

    All pairs with a bucket's smallest node have been looked at, so that one does not count, and all pairs of buckets with
    up to `looked_at` members.
    """
    first = members.groupBy("bucket").agg(F.min("node").alias("_first"), F.count(F.lit(1)).alias("_n"))
    labelled = (members.join(first.where(F.col("_n") > looked_at), "bucket").where("node > _first").select("bucket", "node")
                .join(component, "node", "left")
                .select("bucket", "node", F.coalesce("component", "node").alias("component")))
    mixed = (labelled.groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
             .where("_low < _high").select("bucket"))
    return labelled.join(mixed, "bucket").select("node", "component").distinct()


def prefix_pairs(nodes: DataFrame, elements: DataFrame, percent: int, n_nodes: int | None = None) -> DataFrame:
    """Distinct pairs a < b of nodes in different components that may be linked; every link is among them.

    nodes: node, component; elements: node, element. Sets are ordered by how rare their elements are. Two sets with
    100 * shared >= percent * all share an element among their first ones, and where they first do, the rest of either is
    long enough for what they still have to share.
    """
    rows = elements.join(nodes, "node")
    counts = rows.groupBy("element").agg(F.count(F.lit(1)).alias("n_nodes"))
    whole = Window.partitionBy("node")
    placed = (rows.join(counts, "element")
              .withColumn("pos", F.row_number().over(whole.orderBy("n_nodes", "element")) - 1)
              .withColumn("size", F.count(F.lit(1)).over(whole))
              .where((F.col("pos") * 100 <= F.col("size") * (100 - percent)) & (F.col("n_nodes") > 1))
              .select("element", "node", "component", "pos", "size"))
    return pairs_by_prefix(settle(placed, n_nodes and 8 * n_nodes), percent)


def pairs_by_prefix(placed: DataFrame, percent: int) -> DataFrame:
    """`prefix_pairs` of the first elements of each set: element, node, component, pos (from 0), size.

    Elements may be in any order that is the same for all sets; the rarer the first ones are, the fewer pairs there are.
    """
    left = placed.select("element", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("pos").alias("pa"), F.col("size").alias("na"))
    right = placed.select("element", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("pos").alias("pb"), F.col("size").alias("nb"))
    still = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return (left.join(right, "element")
            .where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
                   & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
                   & (still * (100 + percent) >= (F.col("na") + F.col("nb")) * percent))
            .select("a", "b").distinct())


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """Distributed union-find: node, component (the smallest node reachable) for every node of edges a, b.

    Each round every node joins its smallest neighbour, in an order of nodes that changes from round to round, so long
    chains also shrink by a share; edges inside a merged node go. Rounds end when no edge is left. The joins made in each
    round are kept as a table and followed one after the other at the end. All tables between rounds are `written`.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), rows)
    n = edges.count()
    edges = edges.coalesce(1 + n // ROWS_PER_TASK)
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    order, joined, left, n_left = random.Random(20240115), [], edges, n
    while n_left:
        mask = order.getrandbits(62) if joined else 0
        rank = lambda c: F.col(c).bitwiseXOR(F.lit(mask).cast("long"))  # noqa: E731, B023
        ends = left.select("a", "b").union(left.select("b", "a")).toDF("x", "y")
        parent = written(ends.groupBy("x").agg(F.min(rank("y")).alias("low"))
                         .select("x", F.least(F.col("low"), rank("x")).bitwiseXOR(F.lit(mask).cast("long")).alias("p"))
                         .where("x <> p"), n_left)
        if n_left > BROADCAST_ROWS:
            parent = parent.hint("merge")
        joined.append((parent, n_left))
        left = written(_follow(_follow(left, "a", parent), "b", parent)
                       .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), n_left)
        n_left = left.count()
    found = nodes.withColumn("root", F.col("node"))
    for parent, n_edges in joined:
        found = _follow(found, "root", parent)
        if n_edges > BROADCAST_ROWS:
            found = written(found, 2 * n)
    found = written(found, 2 * n)
    smallest = found.groupBy("root").agg(F.min("node").alias("component"))
    return written(found.join(smallest, "root").select("node", "component"), 2 * n)


def _follow(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    return (df.join(parent, df[column] == parent["x"], "left").withColumn(column, F.coalesce("p", column))
            .drop("x", "p"))
