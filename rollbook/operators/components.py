"""Connected components of a bipartite membership table, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nullsafe import join_same
from ..sources.tables import cut_lineage, deal

#: Turns of :func:`dealt_components` before what is still apart goes to the general search.
TURNS = 3


def _linking(edges: DataFrame) -> DataFrame:
    """The rows of groups that hold more than one node; the others link nothing."""
    return edges.join(edges.groupBy("g").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("g"), "g", "left_semi")


def _contract(edges: DataFrame, turn: int) -> DataFrame:
    """``n, to``: every node of the edges and the node that it becomes: the first in this turn's hashed order among those it shares a group with, and then that one's first."""
    order = F.struct(F.xxhash64("n", F.lit(turn)).alias("h"), F.col("n").alias("to"))
    via = edges.groupBy("g").agg(F.min(order).alias("via"))
    near = edges.join(via, "g").groupBy("n").agg(F.min("via").getField("to").alias("to"))
    return near.join(near.select(F.col("n").alias("to"), F.col("to").alias("further")), "to").select("n", F.col("further").alias("to"))


def connected_components(members: DataFrame, node: str, group: str, out: str = "component") -> DataFrame:
    """Nodes that share a group, directly or through a chain, get the smallest node id of the chain.

    Each round merges nodes into neighbours and keeps only what still links different nodes: equal rows fall together, and a component that has become one node
    leaves the table with its groups. The hashed order shrinks chains and stars alike by a constant factor, so the rounds grow with the logarithm of the
    longest chain while what they read and write falls. The merges of each round are stored once and put together backwards, from the smallest table to the largest.
    Every step is a minimum per key, combined before the shuffle.
    """
    members = members.select(F.col(node).alias("n"), F.col(group).alias("g")).distinct()
    edges, merges = cut_lineage(_linking(members)), []
    while not edges.isEmpty():
        merges.append(cut_lineage(_contract(edges, len(merges))))
        edges = cut_lineage(_linking(edges.join(merges[-1], "n").select(F.col("to").alias("n"), "g").distinct()))
    nodes = members.select("n").distinct()
    if not merges:
        return nodes.select(F.col("n").alias(node), F.col("n").alias(out))
    ends = merges[-1]
    for step in reversed(merges[:-1]):  # a node that left after this step is its own end
        ends = step.join(ends.select(F.col("n").alias("to"), F.col("to").alias("end")), "to", "left").select("n", F.coalesce("end", "to").alias("to"))
    ends = cut_lineage(ends)
    named = ends.join(ends.groupBy("to").agg(F.min("n").alias("label")), "to").select("n", "label")
    nodes = join_same(nodes, named, "n")
    return nodes.select(F.col("n").alias(node), F.coalesce("label", "n").alias(out))


def dealt_components(members: DataFrame, node: str, near: list[str], group: Column, out: str = "component") -> DataFrame:
    """The distinct rows of ``members``, stored, with the component of their node: the same as :func:`connected_components` gives where rows share a group if both ``near`` and ``group`` are equal.

    All groups lie inside one value of ``near``, so the distinct rows are dealt by it, and the smallest label travels from nodes to groups and back in windows where they are. Only what is
    still apart after ``TURNS`` turns, and nodes that occur in several values of ``near``, go to the general search, as labels.
    """
    d = deal(members.distinct(), *near).withColumns({"__g": group, "__label": F.col(node)})
    d = d.withColumns({"__hg": F.xxhash64(*near, "__g"), "__hn": F.xxhash64(*near, node)})  # what rows are compared by first: most keys are texts
    of_group, of_node = Window.partitionBy("__hg", *near, "__g"), Window.partitionBy("__hn", *near, node)
    for _ in range(TURNS):
        d = d.withColumn("__label", F.min("__label").over(of_group)).withColumn("__label", F.min("__label").over(of_node))
    d = d.withColumn("__open", F.min("__label").over(of_group) != F.max("__label").over(of_group)).withColumn("__g", F.when(F.col("__open"), F.col("__g")))
    d = cut_lineage(d.drop("__hg", "__hn"))
    apart = d.filter("__open").select(F.col("__label").alias("n"), F.to_json(F.array(*[F.col(c).cast("string") for c in near], "__g")).alias("g")).distinct()
    several = d.groupBy(node).agg(F.collect_set("__label").alias("s")).filter(F.size("s") > 1).select(F.explode("s").alias("n"), F.to_json(F.array(F.col(node).cast("string"))).alias("g"))
    links = cut_lineage(apart.unionByName(several))
    d = d.drop("__g", "__open")
    if links.isEmpty():
        return d.withColumnRenamed("__label", out)
    ends = connected_components(links, "n", "g", "__end")
    return d.join(ends.withColumnRenamed("n", "__label"), "__label", "left").withColumn(out, F.coalesce("__end", "__label")).drop("__label", "__end")
