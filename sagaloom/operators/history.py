"""History of changing entity attributes (problem 2).

Sources (one snapshot or update stream each) are brought into one shape, reduced map-side to the winning row per key
and session, and range-partitioned together by (key, session), so that a hot key spreads over many partitions. Sorting
within partitions is Spark's external k-way merge over the runs of all sources; a streaming iterator then carries ONE
open version, closes it when the payload or the key changes, and never holds a history in memory. Versions cut by a
partition border are stitched from two summary rows per partition, a number bounded by the partition count.

Defined edge results: rows without a session, entity or known value give no version; a missing evidence is observed;
a blank ``toward`` of an attitude is the party; ties go to the latest moment, then recorded_at, then change_id, nulls
lowest; repeated rows and repeated values make no new version; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sagaloom.functions.names import filled, fold, media_seconds, stripped
from sagaloom.operators.orphans import name_candidates, name_targets
from sagaloom.session import cut, shuffle_partitions

#: State words in the languages of the sources.
STATUS_WORDS = {
    "alive": "alive", "lebendig": "alive", "am leben": "alive", "lebend": "alive",
    "dead": "dead", "tot": "dead", "gestorben": "dead",
    "missing": "missing", "verschollen": "missing", "vermisst": "missing",
    "captured": "captured", "gefangen": "captured",
    "transformed": "transformed", "verwandelt": "transformed",
    "destroyed": "destroyed", "zerstört": "destroyed",
}
ATTITUDE_WORDS = {
    "allied": "allied", "verbündet": "allied",
    "friendly": "friendly", "freundlich": "friendly",
    "neutral": "neutral",
    "wary": "wary", "misstrauisch": "wary",
    "hostile": "hostile", "feindselig": "hostile", "feindlich": "hostile",
}
OBSERVED = ("observed", "beobachtet")
PARTY = "Gruppe"
PARTY_WORDS = ("gruppe", "die gruppe", "party", "die party", "the party", "group", "the group")


def word_of(c: Column, words: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in words.items() for x in pair]
    return F.element_at(F.create_map(*pairs), fold(c))


def is_observed(c: Column) -> Column:
    return ~filled(c) | fold(c).isin(*OBSERVED)


def versions(rows: DataFrame, key: list[str], value: str, session: str, order: list[Column], partitions: int | None = None) -> DataFrame:
    """``key``, ``value``, from_session and to_session ('' while open), one row per version.

    ``order`` ranks several rows of one key and session, the largest wins (nulls lowest). ``key`` columns are strings
    without nulls.
    """
    best = rows.groupBy(*key, F.col(session).alias("__s")).agg(F.max_by(F.col(value), F.struct(*order)).alias("__v"))
    n = partitions or shuffle_partitions(rows.sparkSession)
    sorted_rows = best.repartitionByRange(n, *key, "__s").sortWithinPartitions(*key, "__s").select(*key, "__s", "__v")
    cols = [f"{k} string" for k in key]
    schema = ", ".join([*cols, "__v string", "__s string", "__to string", "__pid int", "__n long", "__last boolean"])

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid, n_out, carried = TaskContext.get().partitionId(), 0, None
        for pdf in batches:
            if not len(pdf):
                continue
            if carried is not None:
                pdf = pd.concat([carried, pdf], ignore_index=True)
            new_key = np.ones(len(pdf), bool)
            same = np.ones(len(pdf) - 1, bool)
            for k in key:
                col = pdf[k].to_numpy()
                same &= col[1:] == col[:-1]
            new_key[1:] = ~same
            vals = pdf["__v"].to_numpy()
            change = new_key.copy()
            change[1:] |= vals[1:] != vals[:-1]
            starts = np.flatnonzero(change)
            out = pdf.iloc[starts[:-1]].copy()
            nxt = starts[1:]
            out["__to"] = np.where(new_key[nxt], "", pdf["__s"].to_numpy()[nxt])
            out["__pid"], out["__n"], out["__last"] = pid, np.arange(n_out, n_out + len(out)), False
            n_out += len(out)
            carried = pdf.iloc[[starts[-1]]]  # the one open version
            yield out[[*key, "__v", "__s", "__to", "__pid", "__n", "__last"]]
        if carried is not None:
            out = carried.copy()
            out["__to"], out["__pid"], out["__n"], out["__last"] = "", pid, n_out, True
            yield out[[*key, "__v", "__s", "__to", "__pid", "__n", "__last"]]

    runs = cut(sorted_rows.mapInPandas(stream, schema))
    spark = rows.sparkSession
    edges = runs.filter((F.col("__n") <= 1) | F.col("__last")).collect()  # at most three rows per partition
    fixes = _stitch([r.asDict() for r in edges], key)
    if not fixes:
        return runs.select(*key, F.col("__v").alias(value), F.col("__s").alias("from_session"), F.col("__to").alias("to_session"))
    patch = F.broadcast(spark.createDataFrame(fixes, "__pid int, __n long, __drop boolean, __new string"))
    return (
        runs.join(patch, ["__pid", "__n"], "left").filter(~F.coalesce("__drop", F.lit(False)))
        .select(*key, F.col("__v").alias(value), F.col("__s").alias("from_session"), F.coalesce("__new", "__to").alias("to_session"))
    )


def _stitch(edges: list[dict], key: list[str]) -> list[tuple[int, int, bool, str | None]]:
    """Corrections (partition, row, drop, new to_session) of the versions at partition borders."""
    ordered = sorted(edges, key=lambda r: (r["__pid"], r["__n"]))
    firsts = {r["__pid"]: r for r in ordered if r["__n"] == 0}
    drop: set[int] = set()
    ends: dict[tuple[int, int], str] = {}
    open_run = None  # the last version that still has no end
    for pid in sorted(firsts):
        mine = [r for r in ordered if r["__pid"] == pid]
        first, last = mine[0], mine[-1]
        if open_run is not None and all(open_run[k] == first[k] for k in key):
            if open_run["__v"] == first["__v"]:
                drop.add(pid)
                if first["__last"]:
                    continue  # the same version goes on in the next partition
                ends[(open_run["__pid"], open_run["__n"])] = first["__to"]
            else:
                ends[(open_run["__pid"], open_run["__n"])] = first["__s"]
        open_run = last
    return [(p, n, False, to) for (p, n), to in ends.items() if to] + [(p, 0, True, None) for p in drop]


def canonical_names(df: DataFrame, column: str, entities: DataFrame) -> DataFrame:
    """``df`` with ``column`` replaced by the canonical name it resolves to, else stripped. Distinct names are resolved once."""
    named = df.select(F.col(column).alias("__raw")).filter(filled(F.col("__raw"))).distinct()
    targets = name_targets(entities).groupBy("name_key").agg(F.min(F.struct("concept_id", "canonical_name")).alias("__t"))
    found = (
        name_candidates(named, "__raw").join(targets, "name_key").groupBy("__raw")
        .agg(F.min_by("__t.canonical_name", "preference").alias("__name"))
    )
    joined = df.join(found, F.col(column) == F.col("__raw"), "left")
    return joined.withColumn(column, F.coalesce("__name", stripped(F.col(column)))).drop("__raw", "__name")


def party_or_character(df: DataFrame, column: str, registry: DataFrame) -> DataFrame:
    """``df`` with ``column`` as the party or a full character name; what resolves to neither stays as typed, stripped."""
    forms = F.concat(
        F.array("character_name", "canonical"), F.coalesce("character_aliases", F.array().cast("array<string>")),
        F.coalesce("aliases", F.array().cast("array<string>")),
    )
    known = (
        registry.filter(filled(F.col("character_name"))).select("character_name", F.explode(forms).alias("__f"))
        .filter(filled(F.col("__f"))).groupBy(fold(F.col("__f")).alias("__k")).agg(F.min("character_name").alias("__c"))
    )
    key = F.regexp_replace(fold(F.col(column)), r"(?U)\s*\([^()]*\)\s*$", "")
    party = ~filled(F.col(column)) | key.isin(*PARTY_WORDS)
    joined = df.withColumn("__k", key).join(known, "__k", "left")
    return joined.withColumn(column, F.when(party, PARTY).otherwise(F.coalesce("__c", stripped(F.col(column))))).drop("__k", "__c")


def attribute_history(status_changes: DataFrame, attitude_changes: DataFrame, entities: DataFrame, registry: DataFrame) -> DataFrame:
    """attribute_name, entity_name, toward, state_value, from_session, to_session of every version."""
    common = ["session_id", "entity_name", "evidence", "citation_ts", "recorded_at", "change_id"]
    status = status_changes.select(
        F.lit("status").alias("attribute_name"), *common, F.lit("").alias("toward"),
        word_of(F.col("status_value"), STATUS_WORDS).alias("state_value"),
    )
    attitude = party_or_character(attitude_changes.select(*common, "toward", "attitude_value"), "toward", registry).select(
        F.lit("attitude").alias("attribute_name"), *common, "toward",
        word_of(F.col("attitude_value"), ATTITUDE_WORDS).alias("state_value"),
    )
    rows = status.unionByName(attitude).filter(
        is_observed(F.col("evidence")) & filled(F.col("session_id")) & filled(F.col("entity_name")) & F.col("state_value").isNotNull()
    )
    named = canonical_names(rows, "entity_name", entities)
    order = [F.coalesce(media_seconds(F.col("citation_ts")), F.lit(-1)), F.col("recorded_at"), F.col("change_id")]
    return versions(named, ["attribute_name", "entity_name", "toward"], "state_value", "session_id", order)


def state_as_of(history: DataFrame, session: str) -> DataFrame:
    """The version of every key valid in ``session``."""
    return history.filter((F.col("from_session") <= session) & ((F.col("to_session") == "") | (F.col("to_session") > session)))
