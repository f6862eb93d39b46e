"""Concept documents and their links, ledgers of threads, snapshots of concepts, and checks on name and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sagaloom.functions.texts import links


def link_table(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, label, target of every link in every document; null texts have none, repeated links stay."""
    return documents.select(key, F.explode(links(F.col(text))).alias("l")).select(key, "l.label", "l.target")


def inbound(edges: DataFrame) -> DataFrame:
    """target, n_links, n_documents of a link table (doc_id, target)."""
    return edges.groupBy("target").agg(F.count("*").alias("n_links"), F.countDistinct("doc_id").alias("n_documents"))


def section_bullets(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, line_no, heading, bullet of every bullet line, under the nearest heading above it ('' before the first)."""
    lines = documents.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    w = Window.partitionBy(key).orderBy("line_no")  # lines of one document
    heading = F.when(F.col("line").rlike("^#+ "), F.trim(F.regexp_replace("line", "^#+ ", "")))
    above = lines.withColumn("heading", F.coalesce(F.last(heading, ignorenulls=True).over(w), F.lit("")))
    return above.filter(F.col("line").rlike("^[-*] ")).select(key, "line_no", "heading", F.trim(F.substring("line", 3, 1_000_000_000)).alias("bullet"))


def alive_at(concepts: DataFrame, moment: Column) -> DataFrame:
    """Concepts created at or before ``moment`` and not retired by then; a concept without creation was always there."""
    return concepts.filter((F.col("created_at").isNull() | (F.col("created_at") <= moment)) & (F.col("retired_at").isNull() | (F.col("retired_at") > moment)))


def rename_guard(before: DataFrame, after: DataFrame, key: str, most: float = 0.02, least: int = 20) -> DataFrame:
    """One row: n_before, n_lost, n_new, refused. Losing more than ``most`` of at least ``least`` ids is refused."""
    sides = before.select(key).distinct().withColumn("__b", F.lit(1)).join(after.select(key).distinct().withColumn("__a", F.lit(1)), key, "full_outer")
    n = lambda c: F.count(F.when(c, 1))
    counts = sides.agg(
        F.count("__b").alias("n_before"), n(F.col("__b").isNotNull() & F.col("__a").isNull()).alias("n_lost"), n(F.col("__b").isNull()).alias("n_new")
    )
    return counts.withColumn("refused", (F.col("n_before") >= least) & (F.col("n_lost") > most * F.col("n_before")))


def thread_ledger(updates: DataFrame) -> DataFrame:
    """thread_id, opened, last_session, status, closed, n_steps: the state of every thread after all its updates.

    Updates apply in order of session, then update_id; one without a status changes nothing but counts as a step. A
    thread is closed since the first session of its last unbroken run of one closing status; reopening clears it.
    """
    known = updates.filter(F.col("thread_id").isNotNull() & (F.lower(F.trim("thread_id")) != "neu") & F.col("session_id").isNotNull())
    steps = known.groupBy("thread_id").agg(F.min("session_id").alias("opened"), F.max("session_id").alias("last_session"), F.count("*").alias("n_steps"))
    w = Window.partitionBy("thread_id").orderBy("session_id", "update_id")  # one thread's updates
    told = known.filter(F.length(F.trim("thread_status")) > 0).select("thread_id", "session_id", "update_id", F.lower(F.trim("thread_status")).alias("status"))
    starts = told.withColumn("before", F.lag("status").over(w)).filter("before is null or before != status")
    last = starts.groupBy("thread_id").agg(F.max_by(F.struct("status", "session_id"), F.struct("session_id", "update_id")).alias("r"))
    return steps.join(last, "thread_id", "left").select(
        "thread_id", "opened", "last_session", F.coalesce("r.status", F.lit("open")).alias("status"), F.when(F.col("r.status") != "open", F.col("r.session_id")).alias("closed"), "n_steps"
    )


def since(rows: DataFrame, key: list[str], order: list[str], value: str, session: str) -> DataFrame:
    """``key``, ``value``, since: the last value of every key and the session in which its present run began."""
    w = Window.partitionBy(*key).orderBy(*order)
    starts = rows.withColumn("__first", F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1)).filter(~F.col("__first"))
    return starts.groupBy(*key).agg(F.max_by(F.struct(F.col(value), F.col(session).alias("since")), F.struct(*order)).alias("__r")).select(*key, "__r.*")


def pair_counts(names: DataFrame, key: str, kind: str) -> DataFrame:
    """check_name, n_pairs: pairs of rows with one name of one kind and of different kinds, counted from group sizes, never written out."""
    per_kind = names.groupBy(key, kind).agg(F.count("*").alias("n"))
    pairs = lambda n: n * (n - 1) / 2
    per_name = per_kind.groupBy(key).agg(F.sum(pairs(F.col("n"))).alias("same"), F.sum("n").alias("all"))
    total = per_name.agg(F.coalesce(F.sum("same"), F.lit(0)).cast("long").alias("same"), F.coalesce(F.sum(pairs(F.col("all"))), F.lit(0)).cast("long").alias("every"))
    return total.select(F.explode(F.array(
        F.struct(F.lit("same_kind").alias("check_name"), F.col("same").alias("n_pairs")), F.struct(F.lit("other_kind").alias("check_name"), (F.col("every") - F.col("same")).alias("n_pairs")),
    )).alias("r")).select("r.*")


def without_forbidden(groups: DataFrame, forbidden: DataFrame, key: str, member: str) -> DataFrame:
    """Rows (key, member) of the groups that hold no forbidden pair (a, b) whole."""
    rows = groups.select(key, member).distinct()
    first = forbidden.join(rows.withColumnRenamed(member, "a"), "a").select(key, "b")
    broken = first.join(rows.withColumnRenamed(member, "b"), [key, "b"]).select(key).distinct()
    return rows.join(broken, key, "left_anti")


def agreement(ratings: DataFrame, item: str, rater: str, verdict: str) -> DataFrame:
    """rater_a, rater_b, n_both, n_same of every two raters; a rater's verdict on an item is its largest, nulls do not count."""
    one = ratings.filter(F.col(verdict).isNotNull() & F.col(rater).isNotNull()).groupBy(item, rater).agg(F.max(verdict).alias("v"))
    a, b = one.select(item, F.col(rater).alias("rater_a"), F.col("v").alias("va")), one.select(item, F.col(rater).alias("rater_b"), F.col("v").alias("vb"))
    met = a.join(b, item).filter("rater_a < rater_b")  # the raters of one item are few
    return met.groupBy("rater_a", "rater_b").agg(F.count("*").alias("n_both"), F.count(F.when(F.col("va") == F.col("vb"), 1)).alias("n_same"))
