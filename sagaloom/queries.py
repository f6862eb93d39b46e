"""Queries of the core's general problems, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sagaloom.operators import drift, history, orphans
from sagaloom.sources.tables import table


def _tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [table(spark, folder, n) for n in names]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return history.attribute_history(*_tables(spark, folder, "status_changes", "attitude_changes", "entities", "player_registry"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return drift.field_changes(table(spark, folder, "roll_lines")).select("file_name", "change_kind", "old_field", "new_field")


def p3_table(spark: SparkSession, folder: str) -> DataFrame:
    """All files as one table in long form, under the consistent field names."""
    lines = table(spark, folder, "roll_lines")
    return drift.unified_table(lines, drift.field_changes(lines))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return orphans.campaign_orphans(*_tables(spark, folder, "thread_updates", "status_changes", "threads", "entities"))


def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    updates, changes, threads, entities = _tables(spark, folder, "thread_updates", "status_changes", "threads", "entities")
    return orphans.orphan_report(orphans.campaign_references(updates, changes), orphans.campaign_orphans(updates, changes, threads, entities))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p2_found, p3_found, p3_table, p7_found, p7_report)}


def _words(column: str, words: dict[str, str]) -> str:
    return f"CASE lower(trim({column})) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items()) + " END"


_SECONDS = """CASE WHEN regexp_full_match(trim(citation_ts), '\\d{1,3}:[0-5]?\\d:[0-5]?\\d')
    THEN split_part(trim(citation_ts), ':', 1)::INT * 3600 + split_part(trim(citation_ts), ':', 2)::INT * 60 + split_part(trim(citation_ts), ':', 3)::INT
    WHEN regexp_full_match(trim(citation_ts), '\\d{1,3}:[0-5]?\\d') THEN split_part(trim(citation_ts), ':', 1)::INT * 60 + split_part(trim(citation_ts), ':', 2)::INT
    ELSE -1 END"""
_PARTY = ", ".join(f"'{w}'" for w in history.PARTY_WORDS)
_GLOSS = "'\\s*(\\([^()]*\\)|\\[[^\\[\\]]*\\])\\s*$'"
_NAMES = f"""
  targets AS (SELECT DISTINCT lower(trim(nm)) AS k, concept_id, canonical_name, created_at, retired_at
              FROM (SELECT *, unnest(list_append(coalesce(aliases, []), canonical_name)) AS nm FROM entities) WHERE trim(coalesce(nm, '')) <> '')"""
_REFS = """
  refs AS (SELECT DISTINCT ref_table, ref_field, row_id, ref_value, recorded_at FROM (
      SELECT 'thread_updates' AS ref_table, 'thread_id' AS ref_field, update_id AS row_id, thread_id AS ref_value, recorded_at FROM thread_updates WHERE lower(trim(thread_id)) <> 'neu'
      UNION ALL SELECT 'thread_updates', 'involves', update_id, unnest(involves), recorded_at FROM thread_updates
      UNION ALL SELECT 'status_changes', 'entity_name', change_id, entity_name, recorded_at FROM status_changes) WHERE trim(coalesce(ref_value, '')) <> '')"""
_ORPHANS = f"""
WITH {_NAMES}, {_REFS},
  goals AS (SELECT 'n' AS space, k, created_at, retired_at FROM targets UNION ALL SELECT 't', lower(trim(thread_id)), created_at, retired_at FROM threads),
  keyed AS (SELECT *, CASE ref_field WHEN 'thread_id' THEN 't' ELSE 'n' END AS space, lower(trim(ref_value)) AS k1,
              CASE ref_field WHEN 'thread_id' THEN lower(trim(ref_value)) ELSE trim(regexp_replace(lower(trim(ref_value)), {_GLOSS}, '')) END AS k2 FROM refs),
  states AS (SELECT r.ref_table, r.ref_field, r.row_id, r.ref_value, (g.k <> r.k1)::INT AS pref,
      CASE WHEN g.k IS NULL THEN 3 WHEN r.recorded_at < g.created_at THEN 1 WHEN r.recorded_at >= g.retired_at THEN 2 ELSE 0 END AS state
    FROM keyed r LEFT JOIN goals g ON g.space = r.space AND (g.k = r.k1 OR g.k = r.k2)),
  best AS (SELECT ref_table, ref_field, row_id, ref_value, arg_min(state, struct_pack(a := CASE state WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END, b := pref, c := state)) AS state
    FROM states GROUP BY ALL)"""

ORACLE: dict[str, str] = {
    "p2_found": f"""
WITH {_NAMES},
  names AS (SELECT k, arg_min(canonical_name, concept_id) AS c FROM targets GROUP BY k),
  people AS (SELECT lower(trim(f)) AS k, min(character_name) AS c FROM (SELECT character_name,
      unnest(list_concat([character_name, canonical], list_concat(coalesce(character_aliases, []), coalesce(aliases, [])))) AS f
      FROM player_registry WHERE trim(coalesce(character_name, '')) <> '') WHERE trim(coalesce(f, '')) <> '' GROUP BY 1),
  rows_in AS (SELECT 'status' AS attribute_name, session_id, entity_name, '' AS toward, {_words('status_value', history.STATUS_WORDS)} AS v, evidence, {_SECONDS} AS sec, recorded_at, change_id FROM status_changes
    UNION ALL SELECT 'attitude', session_id, entity_name,
      CASE WHEN trim(coalesce(toward, '')) = '' OR lower(trim(toward)) IN ({_PARTY}) THEN 'Gruppe' ELSE coalesce(p.c, trim(toward)) END,
      {_words('attitude_value', history.ATTITUDE_WORDS)}, evidence, {_SECONDS}, recorded_at, change_id
      FROM attitude_changes LEFT JOIN people p ON p.k = lower(trim(toward))),
  kept AS (SELECT r.*, coalesce(n1.c, n2.c, trim(r.entity_name)) AS nm FROM rows_in r LEFT JOIN names n1 ON n1.k = lower(trim(r.entity_name))
    LEFT JOIN names n2 ON n2.k = trim(regexp_replace(lower(trim(r.entity_name)), {_GLOSS}, ''))
    WHERE (trim(coalesce(evidence, '')) = '' OR lower(trim(evidence)) IN ('observed', 'beobachtet')) AND v IS NOT NULL AND trim(coalesce(session_id, '')) <> '' AND trim(coalesce(entity_name, '')) <> ''),
  per AS (SELECT attribute_name, nm, toward, session_id, v FROM (SELECT *, row_number() OVER (PARTITION BY attribute_name, nm, toward, session_id ORDER BY sec DESC, recorded_at DESC NULLS LAST, change_id DESC) AS rn FROM kept) WHERE rn = 1),
  marked AS (SELECT *, lag(v) OVER w AS before FROM per WINDOW w AS (PARTITION BY attribute_name, nm, toward ORDER BY session_id)),
  starts AS (SELECT * FROM marked WHERE before IS NULL OR before <> v)
SELECT attribute_name, nm AS entity_name, toward, v AS state_value, session_id AS from_session,
  coalesce(lead(session_id) OVER (PARTITION BY attribute_name, nm, toward ORDER BY session_id), '') AS to_session FROM starts""",
    "p7_found": _ORPHANS + """
SELECT ref_table, ref_field, row_id, ref_value, CASE state WHEN 1 THEN 'late' WHEN 2 THEN 'deleted' ELSE 'missing' END AS orphan_kind FROM best WHERE state > 0""",
    "p7_report": _ORPHANS + """
SELECT b.ref_table, b.ref_field, coalesce(strftime(m.at, '%Y-%m'), '') AS ref_month, count(*) AS n_refs,
  count(*) FILTER (state = 3) AS n_missing, count(*) FILTER (state = 1) AS n_late, count(*) FILTER (state = 2) AS n_deleted
FROM best b JOIN (SELECT ref_table, ref_field, row_id, ref_value, min(recorded_at) AS at FROM refs GROUP BY ALL) m USING (ref_table, ref_field, row_id, ref_value)
GROUP BY ALL""",
}
