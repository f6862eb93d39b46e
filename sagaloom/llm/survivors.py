"""Best representative of each duplicate group (problem 5), with currency reasoning.

A group's survivor is chosen field by field: among its members with a real value the one that leads in quality, then
in recency, then in mention count. Where timestamps are missing, recency is reasoned: over all groups, consecutive real
values of timestamped members teach which value is followed by which; a learned precedence holds where one direction
was seen more often than the other. Within a group these precedences form a partial order, and among members that
quality and timestamps leave equal the topologically latest value wins.

``latest_values`` lets the learned order speak first wherever a time is missing: there the topologically latest value
wins, whatever its quality.

A group is the array of one row, so its members are bounded by that row; precedences are counted map-side over all
groups and joined by (field, value). Members are brought together with their records once, placed by group and cut;
everything after that stays where it is, and orders are only built for groups that need one.

Defined edge results: members are the distinct ids with a record; smaller groups than two drop out; proposals with the
same members are one group, under the id with the highest confidence (null lowest), then the smallest id; stand-ins
(n/a, tbd, ???, blanks ...) and nulls are no values; null quality and null time rank lowest; equal members are ordered by
mention count, then the smallest concept_id; a field without any real value gives no row; empty tables give an empty result.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sagaloom.functions.names import fold
from sagaloom.session import cut, shuffle_partitions

FIELDS = ("title", "subtype", "description", "home", "resource_url")
#: Stand-ins for a missing value, folded.
STAND_INS = ("", "-", "--", "n/a", "na", "k. a.", "k.a.", "???", "??", "?", "tbd", "todo", "unbekannt", "unknown", "none", "null", "nan", "leer")
LEVELS = ("niedrig", "mittel", "hoch")


def level(c: Column) -> Column:
    """0 for null or anything unknown, then niedrig, mittel, hoch."""
    x = fold(c)
    return F.coalesce(F.when(x == LEVELS[0], 1).when(x == LEVELS[1], 2).when(x == LEVELS[2], 3), F.lit(0))


def is_real(c: Column) -> Column:
    return c.isNotNull() & ~fold(c).isin(*STAND_INS)


def members(merge_groups: DataFrame, records: DataFrame) -> DataFrame:
    """group_id, concept_id of the groups that count."""
    known = records.select("concept_id").filter("concept_id is not null").distinct()
    listed = merge_groups.select("group_id", level(F.col("confidence")).alias("conf"), F.explode(F.array_distinct("concept_ids")).alias("concept_id"))
    sets = listed.join(known, "concept_id", "left_semi").groupBy("group_id", "conf").agg(F.array_sort(F.collect_set("concept_id")).alias("ids"))
    once = sets.filter(F.size("ids") > 1).groupBy("ids").agg(F.min_by("group_id", F.struct(-F.col("conf"), "group_id")).alias("group_id"))
    return once.select("group_id", F.explode("ids").alias("concept_id"))


def member_records(merge_groups: DataFrame, records: DataFrame) -> DataFrame:
    """One row per group and member, placed by group: group_id, concept_id, q, updated_at, mention_count, fields.

    Of several records of one id the one that leads in quality, time, mention count and then in its values counts.
    """
    fields = [F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in FIELDS]
    rows = records.select("concept_id", F.struct(level(F.col("quality")).alias("q"), "updated_at", "mention_count", F.array(*fields).alias("fields")).alias("r"))
    best = rows.groupBy("concept_id").agg(F.max("r").alias("r"))
    joined = members(merge_groups, records).join(best, "concept_id").select("group_id", "concept_id", "r.*")
    return cut(joined.repartition(shuffle_partitions(records.sparkSession), "group_id"))


def field_values(people: DataFrame) -> DataFrame:
    """One row per group, member and really filled field: group_id, field_name, concept_id, value, q, updated_at, mention_count."""
    long = people.select("group_id", "concept_id", "q", "updated_at", "mention_count", F.explode("fields").alias("f"))
    return long.select("group_id", "f.field_name", "concept_id", "f.value", "q", "updated_at", "mention_count").filter(is_real(F.col("value")))


def precedences(rows: DataFrame) -> DataFrame:
    """field_name, earlier, later: value transitions seen more often than their reverse between timestamped members."""
    w = Window.partitionBy("group_id", "field_name").orderBy("updated_at", "concept_id")  # one group's members
    steps = (
        rows.filter("updated_at is not null").select("field_name", F.lag("value").over(w).alias("earlier"), F.col("value").alias("later"))
        .filter("earlier != later").groupBy("field_name", "earlier", "later").agg(F.count("*").alias("n"))
    )
    back = steps.select("field_name", F.col("earlier").alias("later"), F.col("later").alias("earlier"), F.col("n").alias("m"))
    return steps.join(back, ["field_name", "earlier", "later"], "left").filter("n > coalesce(m, 0)").select("field_name", "earlier", "later")


CYCLE_PLACE = 12  # the first place of values on a cycle, where the walk of the SQL has them; other places have no bound


def lateness(steps: list[tuple[str, str]]) -> dict[str, int]:
    """The place of every value: later than all values before it, but for those on a cycle with it.

    Without a cycle that is the longest walk that ends in the value. Values on one cycle share a place.
    """
    after: dict[str, list[str]] = {v: [] for step in steps for v in step}
    before: dict[str, list[str]] = {v: [] for v in after}
    for a, b in steps:
        after[a].append(b)
        before[b].append(a)
    left, seen = [], set()  # depth first; of two values not on a cycle the earlier is left last
    for start in after:
        path = [] if start in seen else [(start, iter(after[start]))]
        seen.add(start)
        while path:
            v = next((x for x in path[-1][1] if x not in seen), None)
            if v is None:
                left.append(path.pop()[0])
            else:
                seen.add(v)
                path.append((v, iter(after[v])))
    depth: dict[str, int] = {}
    for v in reversed(left):
        if v in depth:
            continue
        ring, todo = {v}, [v]  # the values on a cycle with v
        while todo:
            more = {x for x in before[todo.pop()] if x not in depth} - ring
            ring |= more
            todo += more
        place = max((depth[x] + 1 for y in ring for x in before[y] if x not in ring), default=0)
        depth |= dict.fromkeys(ring, max(place, CYCLE_PLACE) if len(ring) > 1 else place)
    return depth


def currency(values: DataFrame, learned: DataFrame) -> DataFrame:
    """group_id, field_name, value, depth: how late a value is in its group's partial order (nothing precedes 0, which has no row).

    ``values`` are the different (group_id, field_name, value) of the groups in question; only edges inside a group count.
    """
    out = values.withColumnRenamed("value", "earlier").join(learned, ["field_name", "earlier"])
    edges = out.join(values.withColumnRenamed("value", "later"), ["group_id", "field_name", "later"], "left_semi")

    def depths(pdf: pd.DataFrame) -> pd.DataFrame:
        depth = lateness(list(zip(pdf.earlier, pdf.later, strict=True)))
        return pd.DataFrame({"group_id": pdf.group_id.iloc[0], "field_name": pdf.field_name.iloc[0], "value": list(depth), "depth": list(depth.values())})

    return edges.groupBy("group_id", "field_name").applyInPandas(depths, "group_id long, field_name string, value string, depth int")


def _place(*first: Column) -> list[Column]:
    return [*first, F.col("mention_count").desc_nulls_last(), F.col("concept_id")]


def survivors(merge_groups: DataFrame, records: DataFrame) -> DataFrame:
    """group_id, field_name, concept_id, value: the canonical member (field ``canonical``) and the best member of every field."""
    people = member_records(merge_groups, records)
    rows = field_values(people)
    of_field = Window.partitionBy("group_id", "field_name")
    lead = [F.col("q").desc(), F.col("updated_at").desc_nulls_last()]
    # the leaders in quality and time; only where they differ in value the learned order has to speak
    top = rows.withColumn("__r", F.rank().over(of_field.orderBy(*lead))).filter("__r = 1").drop("__r")
    spread = cut(top.withColumn("__n", (F.min("value").over(of_field) != F.max("value").over(of_field))))
    undecided = spread.filter("__n").select("group_id", "field_name").distinct()
    asked = rows.filter("updated_at is null").join(undecided, ["group_id", "field_name"], "left_semi").select("group_id", "field_name").distinct()
    late = currency(rows.join(asked, ["group_id", "field_name"], "left_semi").select("group_id", "field_name", "value").distinct(), precedences(rows))
    ranked = spread.join(late, ["group_id", "field_name", "value"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    first = ranked.withColumn("__k", F.row_number().over(of_field.orderBy(*_place(F.col("depth").desc())))).filter("__k = 1")
    canon = people.withColumn("__k", F.row_number().over(Window.partitionBy("group_id").orderBy(*_place(*lead)))).filter("__k = 1")
    return first.select("group_id", "field_name", "concept_id", "value").unionByName(
        canon.select("group_id", F.lit("canonical").alias("field_name"), "concept_id", F.col("concept_id").alias("value"))
    )


def latest_values(merge_groups: DataFrame, records: DataFrame) -> DataFrame:
    """group_id, field_name, concept_id, value, depth: the current value of every field that has a member without a time.

    The topologically latest value wins; among equally late ones quality, time, mention count and the smallest id decide.
    """
    rows = field_values(member_records(merge_groups, records))
    asked = rows.filter("updated_at is null").select("group_id", "field_name").distinct()
    mine = rows.join(asked, ["group_id", "field_name"], "left_semi")
    late = currency(mine.select("group_id", "field_name", "value").distinct(), precedences(rows))
    ranked = mine.join(late, ["group_id", "field_name", "value"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    order = _place(F.col("depth").desc(), F.col("q").desc(), F.col("updated_at").desc_nulls_last())
    first = ranked.withColumn("__k", F.row_number().over(Window.partitionBy("group_id", "field_name").orderBy(*order))).filter("__k = 1")
    return first.select("group_id", "field_name", "concept_id", "value", "depth")
