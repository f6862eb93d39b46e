"""Consolidating pairwise matches into groups (problem 6): connected components by hierarchical union-find.

Every partition of the edge list, as it is read, runs union-find and keeps only its spanning forest (each node with the
smallest node of its tree), so nothing is shuffled before it is reduced. A task that has met ``max_edges`` nodes hands its
forest on and begins a new one, so no task holds more, however large its partition or its component is. Forests are then
merged hierarchically: shuffled by whole rows into as many partitions as the rows left need, ``FAN_IN`` times fewer each
time, as long as that makes them fewer. If all that is left fits one partition, its forest is the answer. If not, ``joined``
links the roots of a node with each other and takes every root on to its own root, pass by pass, until no node has two
roots and no root has another root. These passes are plain aggregations and joins, which spill, so no task holds a forest
in memory; a chain takes about log2 of its length. The rows of one root are a skewed join key, which adaptive execution
splits.

Defined edge results: null ids and self links link nothing; repeated and reversed pairs count once; ids are compared by
character code; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sagaloom.session import cut, shuffle_partitions

MAX_EDGES = 2_000_000  # rows of a merged partition: about 300 MB of Python objects
FAN_IN = 8
MAX_PASSES = 60


def forest(batches: Iterator[pd.DataFrame], most: int = MAX_EDGES) -> Iterator[pd.DataFrame]:
    """Spanning forests of edges (a, b): every node but the smallest of its tree, with that smallest one. At most ``most`` nodes (and one edge) at a time."""
    number: dict[str, int] = {}
    names: list[str] = []
    parent: list[int] = []

    def node(x: str) -> int:
        i = number.get(x)
        if i is None:
            i = number[x] = len(names)
            names.append(x)
            parent.append(i)
        return i

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def rows() -> Iterator[pd.DataFrame]:
        step = 100_000
        for start in range(0, len(names), step):
            ids = range(start, min(start + step, len(names)))
            found = [(names[i], names[r]) for i in ids if i != (r := root(i))]
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])
        number.clear(), names.clear(), parent.clear()

    for pdf in batches:
        for a, b in zip(pdf["a"].to_numpy(), pdf["b"].to_numpy(), strict=True):
            i, j = root(node(a)), root(node(b))
            if i != j:
                if names[i] < names[j]:
                    parent[j] = i
                else:
                    parent[i] = j
            if len(names) > most:
                yield from rows()
    yield from rows()


def joined(trees: DataFrame) -> DataFrame:
    """One pass over rows (a, b), b < a: a node keeps its smallest b, its other ones are linked with that, and every b gives way to its own smallest.

    The rows hold the same components before and after, and each pass that changes any lowers their ids, so passes end.
    """
    low = cut(trees.groupBy("a").agg(F.min("b").alias("low")))
    linked = trees.join(low, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
    up = low.select(F.col("a").alias("b"), F.col("low").alias("up"))
    return linked.join(up, "b", "left").select("a", F.coalesce("up", "b").alias("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_edges: int = MAX_EDGES) -> DataFrame:
    """node, group_key: every linked node and the smallest node of its component."""
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a != b")
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    grown = lambda df: cut(df.mapInPandas(lambda batches: forest(batches, max_edges), "a string, b string"))
    trees = grown(pairs)
    rows = trees.count()
    needed = lambda: max(1, ceil(2 * rows / max_edges))  # partitions: a row has at most two nodes
    parts = shuffle_partitions(edges.sparkSession) * FAN_IN
    while True:
        before, parts = rows, max(needed(), ceil(parts / FAN_IN))
        # the number is given, so adaptive execution leaves it
        trees = grown(trees.repartition(parts, "a", "b"))
        rows = trees.count()
        if parts == 1 or (parts <= needed() and rows > 0.9 * before):
            break
    for _ in range(MAX_PASSES):
        if parts == 1:
            break
        trees = cut(joined(trees))
        split = trees.groupBy("a").agg(F.countDistinct("b").alias("n")).filter("n > 1")
        nested = trees.select("b").distinct().join(trees.select(F.col("a").alias("b")), "b", "left_semi")
        if split.isEmpty() and nested.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle within {MAX_PASSES} passes")
    return trees.select(F.col("a").alias("node"), F.col("b").alias("group_key")).unionByName(
        trees.select(F.col("b").alias("node"), F.col("b").alias("group_key")).distinct()
    )


def chained(ids: Column) -> Column:
    """Neighbouring pairs of an array: they link the same ids as all pairs would."""
    n = F.size(ids)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(F.element_at(ids, i).alias("a"), F.element_at(ids, i + 1).alias("b"))))


def record_links(merge_groups: DataFrame, adjudications: DataFrame, records: DataFrame) -> DataFrame:
    """a, b of the links between records: ids in one merge group, and candidates whose latest verdict is true.

    A verdict is superseded by a later one of its candidate, also by a null; at equal times a verdict counts before a
    null, and true before false.
    """
    known = records.select(F.col("concept_id").alias("id")).filter("id is not null").distinct()
    listed = merge_groups.select("group_id", F.explode(F.array_distinct("concept_ids")).alias("id")).filter("id is not null")
    members = listed.join(known, "id", "left_semi").groupBy("group_id").agg(F.collect_set("id").alias("ids"))  # ids of one row's array
    grouped = members.select(F.explode(chained(F.col("ids"))).alias("l")).select("l.*")
    order = F.struct("judged_at", F.col("same_entity").isNotNull(), F.col("same_entity"))
    latest = adjudications.groupBy("session_id", "candidate_index").agg(F.max_by(F.struct("same_entity", "new_id", "existing_id"), order).alias("v"))
    judged = latest.filter("v.same_entity").select(F.col("v.new_id").alias("a"), F.col("v.existing_id").alias("b"))
    for side in ("a", "b"):
        judged = judged.join(known.select(F.col("id").alias(side)), side, "left_semi")
    return grouped.unionByName(judged.select("a", "b"))


def linked_records(merge_groups: DataFrame, adjudications: DataFrame, records: DataFrame) -> DataFrame:
    """concept_id, group_key of every record linked to another one."""
    return components(record_links(merge_groups, adjudications, records)).select(F.col("node").alias("concept_id"), "group_key")
