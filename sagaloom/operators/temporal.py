"""Runs, current state, validity intervals, snapshots and change feeds over keyed, ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collapse_runs(rows: DataFrame, key: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The first row of every run of equal ``values`` per key, in ``order``."""
    w = Window.partitionBy(*key).orderBy(*order)
    same = F.lit(True)
    for v in values:
        same = same & F.lag(v).over(w).eqNullSafe(F.col(v))
    return rows.withColumn("__keep", (F.row_number().over(w) == 1) | ~same).filter("__keep").drop("__keep")


def current_state(rows: DataFrame, key: list[str], order: list[str], trusted: Column) -> DataFrame:
    """Per key the last trusted row, else the last row; an aggregation, not a window."""
    place = F.struct(F.coalesce(trusted, F.lit(False)).alias("__t"), *order)
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), place).alias("__r")).select(*key, "__r.*")


def validity(rows: DataFrame, key: list[str], order: list[str], start: str) -> DataFrame:
    """Every row with valid_from and valid_to (the start of its key's next row, null while open)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("valid_from", F.col(start)).withColumn("valid_to", F.lead(start).over(w))


def as_of(rows: DataFrame, moment: Column) -> DataFrame:
    """Rows valid at ``moment``; a row without valid_from is always valid."""
    return rows.filter(F.col("valid_from").isNull() | ((F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))))


def change_feed(before: DataFrame, after: DataFrame, key: str, payload: str) -> DataFrame:
    """key and change (created, updated, deleted) between two snapshots, by the hashes of their payloads."""
    hashed = lambda df, name: df.select(key, F.sha2(F.coalesce(F.col(payload).cast("string"), F.lit("")), 256).alias(name))
    joined = hashed(before, "old").join(hashed(after, "new"), key, "full_outer")
    change = F.when(F.col("old").isNull(), "created").when(F.col("new").isNull(), "deleted").when(F.col("old") != F.col("new"), "updated")
    return joined.select(key, change.alias("change")).filter("change is not null")


def dormant(rows: DataFrame, key: str, session: str, least: int) -> DataFrame:
    """Keys whose last session lies at least ``least`` sessions before the newest; sessions are numbered over the data."""
    counted = rows.groupBy(key).agg(F.max(session).alias("last_session"))
    # one row per session comes together; how many are later is a difference of numbers, not a join on order
    after = rows.select(F.col(session).alias("last_session")).distinct().withColumn("later_sessions", F.row_number().over(Window.orderBy(F.desc("last_session"))) - 1)
    late = after.filter(F.col("later_sessions") >= least).withColumn("later_sessions", F.col("later_sessions").cast("long"))
    return counted.join(late, "last_session").select(key, "last_session", "later_sessions")


def merged_intervals(rows: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Overlapping or touching intervals of a key as one (gaps and islands)."""
    w = Window.partitionBy(*key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.select(*key, start, end, F.when(F.col(start) <= reach, 0).otherwise(1).alias("__new"))
    island = marked.withColumn("__i", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*key, "__i").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__i")
