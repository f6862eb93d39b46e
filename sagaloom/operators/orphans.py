"""References to records that do not exist (problem 7).

Composite keys may be partly null. References are grouped by their null mask; each mask is joined to the targets on
its non-null columns only, under the declared match semantics:

* ``partial``  a reference is satisfied by a target equal in its non-null columns,
* ``simple``   a reference with any null is satisfied without a target,
* ``full``     a reference with some but not all columns null is an orphan.

A reference with all columns null refers to nothing under any semantics and never comes out.

A matched reference can still be out of the target's life time: ``late`` is a reference recorded before its target
began, ``deleted`` one recorded at or after its target ended. A reference with several matches is an orphan only if
none of them was alive. A null time of the reference, a null beginning and a null end bound nothing.

Defined edge results: empty references give an empty result, empty targets make every non-null reference ``missing``;
repeated references come out once per ``ref_id``; repeated targets change nothing; further columns with any name are
ignored because only the named columns are read. Hot reference values are spread by the adaptive skew join, and the
outcome is aggregated map-side per reference, so no group is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sagaloom.functions.names import filled, fold, stripped, without_gloss

OK, LATE, DELETED, MISSING = 0, 1, 2, 3
MAX_KEYS = 6  # one join branch for each of the 2^k - 1 null masks


def find_orphans(
    refs: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    ref_id: Sequence[str],
    match: str = "partial",
    at: str | None = None,
    begins: str | None = None,
    ends: str | None = None,
    preference: str | None = None,
) -> DataFrame:
    """``ref_id`` columns and ``orphan_kind`` of every reference without a living target.

    ``refs`` may hold one reference several times with alternative keys; ``preference`` (smaller first) says whose
    outcome counts when no alternative finds a living target.
    """
    if match not in ("partial", "simple", "full"):
        raise ValueError(f"unknown match semantics {match!r}")
    if not 0 < len(keys) <= MAX_KEYS:
        raise ValueError(f"one to {MAX_KEYS} key columns, not {len(keys)}")
    none = F.lit(None).cast("timestamp_ntz")
    left = refs.select(
        F.struct(*[F.col(c) for c in ref_id]).alias("__ref"),
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        (F.col(at) if at else none).alias("__at"),
        (F.col(preference) if preference else F.lit(0)).alias("__pref"),
    )
    right = targets.select(
        *[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)],
        (F.col(begins) if begins else none).alias("__from"),
        (F.col(ends) if ends else none).alias("__to"),
    )
    branches = []
    for mask in product((True, False), repeat=len(keys)):
        present = [i for i, there in enumerate(mask) if there]
        if not present:
            continue
        some = left
        for i, there in enumerate(mask):
            some = some.filter(F.col(f"__k{i}").isNotNull() if there else F.col(f"__k{i}").isNull())
        if len(present) < len(keys) and match == "simple":
            branches.append(some.select("__ref", "__pref", F.lit(OK).alias("__state")))
            continue
        if len(present) < len(keys) and match == "full":
            branches.append(some.select("__ref", "__pref", F.lit(MISSING).alias("__state")))
            continue
        wanted = [f"__t{i}" for i in present]
        there = right.dropna(subset=wanted).select(*wanted, "__from", "__to").distinct().withColumn("__hit", F.lit(True))
        on = [F.col(f"__k{i}") == F.col(f"__t{i}") for i in present]
        state = (
            F.when(F.col("__hit").isNull(), MISSING)
            .when(F.col("__at") < F.col("__from"), LATE)
            .when(F.col("__at") >= F.col("__to"), DELETED)
            .otherwise(OK)
        )
        branches.append(some.join(there, on, "left").select("__ref", "__pref", state.alias("__state")))
    outcomes = branches[0]
    for b in branches[1:]:
        outcomes = outcomes.unionByName(b)
    kind = F.element_at(F.array(F.lit("late"), F.lit("deleted"), F.lit("missing")), F.col("__best.state"))
    # a living target wins, then a target out of its life time before none at all, then the preferred alternative
    order = F.struct(
        F.when(F.col("__state") == OK, 0).when(F.col("__state") == MISSING, 2).otherwise(1).alias("rank"),
        F.col("__pref").alias("pref"), F.col("__state").alias("state"),
    )
    return (
        outcomes.groupBy("__ref").agg(F.min(order).alias("__best")).filter(F.col("__best.state") != OK)
        .select("__ref.*", kind.alias("orphan_kind"))
    )


def name_targets(entities: DataFrame) -> DataFrame:
    """One row per folded canonical name or alias: name_key, concept_id, canonical_name, created_at, retired_at."""
    names = F.concat(F.array("canonical_name"), F.coalesce(F.col("aliases"), F.array().cast("array<string>")))
    return (
        entities.select("concept_id", "canonical_name", "created_at", "retired_at", F.explode(names).alias("__n"))
        .filter(filled(F.col("__n")))
        .select(fold(F.col("__n")).alias("name_key"), "concept_id", "canonical_name", "created_at", "retired_at")
        .distinct()
    )


def name_candidates(df: DataFrame, column: str) -> DataFrame:
    """``df`` with name_key and preference: the folded name (0) and, where it differs, the name without a gloss (1)."""
    folded = fold(F.col(column))
    bare = without_gloss(folded)
    keys = F.array(
        F.struct(folded.alias("name_key"), F.lit(0).alias("preference")),
        F.when((bare != folded) & (F.length(bare) > 0), F.struct(bare.alias("name_key"), F.lit(1).alias("preference"))),
    )
    return df.withColumn("__c", F.explode(F.filter(keys, lambda k: k.isNotNull()))).select("*", "__c.*").drop("__c")


def campaign_references(thread_updates: DataFrame, status_changes: DataFrame) -> DataFrame:
    """Every reference of the two tables: ref_table, ref_field, row_id, ref_value, recorded_at. New threads and blanks are none."""

    def of(df: DataFrame, table: str, field: str, row_id: str, value) -> DataFrame:
        return df.select(
            F.lit(table).alias("ref_table"), F.lit(field).alias("ref_field"), F.col(row_id).alias("row_id"),
            value.alias("ref_value"), "recorded_at",
        ).filter(filled(F.col("ref_value")))

    threads = of(thread_updates, "thread_updates", "thread_id", "update_id", F.col("thread_id"))
    threads = threads.filter(F.lower(stripped(F.col("ref_value"))) != "neu")
    involved = of(thread_updates, "thread_updates", "involves", "update_id", F.explode("involves"))
    named = of(status_changes, "status_changes", "entity_name", "change_id", F.col("entity_name"))
    return threads.unionByName(involved).unionByName(named)


def campaign_orphans(thread_updates: DataFrame, status_changes: DataFrame, threads: DataFrame, entities: DataFrame) -> DataFrame:
    """Orphans of the campaign tables. The composite key is (name_key, thread_key); a reference fills one of the two."""
    refs = campaign_references(thread_updates, status_changes)
    null = F.lit(None).cast("string")
    to_names = name_candidates(refs.filter(F.col("ref_field") != "thread_id"), "ref_value").withColumn("thread_key", null)
    to_threads = refs.filter(F.col("ref_field") == "thread_id").select(
        "*", null.alias("name_key"), F.lit(0).alias("preference"), fold(F.col("ref_value")).alias("thread_key")
    )
    targets = (
        name_targets(entities).select("name_key", null.alias("thread_key"), "created_at", "retired_at")
        .unionByName(threads.select(null.alias("name_key"), fold(F.col("thread_id")).alias("thread_key"), "created_at", "retired_at"))
    )
    return find_orphans(
        to_names.unionByName(to_threads), targets, ("name_key", "thread_key"),
        ("ref_table", "ref_field", "row_id", "ref_value"), "partial", "recorded_at", "created_at", "retired_at", "preference",
    )


def orphan_report(refs: DataFrame, orphans: DataFrame) -> DataFrame:
    """Per table, field and month of recording: references, and orphans by kind. A null time counts under month ''."""
    key = ["ref_table", "ref_field", "row_id", "ref_value"]
    marked = refs.groupBy(*key).agg(F.min("recorded_at").alias("recorded_at")).join(orphans, key, "left")
    month = F.coalesce(F.date_format("recorded_at", "yyyy-MM"), F.lit("")).alias("ref_month")
    count = lambda k: F.count(F.when(F.col("orphan_kind") == k, 1)).alias(f"n_{k}")
    return marked.groupBy("ref_table", "ref_field", month).agg(
        F.count("*").alias("n_refs"), count("missing"), count("late"), count("deleted")
    )
