"""Queries of the operators on text, and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sagaloom.llm import abuse, components, mixing, packing, survivors, turns, variants
from sagaloom.sources.tables import table


def _tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [table(spark, folder, n) for n in names]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return turns.turn_bounds(turns.speech(*_tables(spark, folder, "segments", "player_registry")))


def p1_turns(spark: SparkSession, folder: str) -> DataFrame:
    return turns.turns(*_tables(spark, folder, "segments", "player_registry"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return variants.resolve(*_tables(spark, folder, "mentions", "entities", "player_registry"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return survivors.survivors(*_tables(spark, folder, "merge_groups", "concept_records")).select("group_id", "field_name", "concept_id")


def p5_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """One row per group: the canonical id and the best value of every field."""
    rows = survivors.survivors(*_tables(spark, folder, "merge_groups", "concept_records"))
    value = lambda f: F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f)
    return rows.groupBy("group_id").agg(value("canonical"), *[value(f) for f in survivors.FIELDS])


def p5_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The current value of every field with a member without a time, by the learned order of values."""
    return survivors.latest_values(*_tables(spark, folder, "merge_groups", "concept_records"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return components.linked_records(*_tables(spark, folder, "merge_groups", "adjudications", "concept_records"))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.containers(table(spark, folder, "documents"))


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill_report(packing.containers(table(spark, folder, "documents")))


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(*_tables(spark, folder, "documents", "mix_targets"))


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    documents, targets = _tables(spark, folder, "documents", "mix_targets")
    return mixing.mix_report(mixing.mixture(documents, targets), targets)


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return abuse.scored(*_tables(spark, folder, "documents", "doc_labels")).filter("abusive").select("doc_id")


def p10_scores(spark: SparkSession, folder: str) -> DataFrame:
    return abuse.scored(*_tables(spark, folder, "documents", "doc_labels"))


def p10_source_rates(spark: SparkSession, folder: str) -> DataFrame:
    return abuse.source_rates(abuse.scored(*_tables(spark, folder, "documents", "doc_labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_turns, p4_found, p5_found, p5_survivors, p5_latest, p6_found, p8_containers, p8_report, p9_mixture, p9_report, p10_found, p10_scores, p10_source_rates)
}

_LEVEL = "CASE lower(trim({0})) WHEN 'niedrig' THEN 1 WHEN 'mittel' THEN 2 WHEN 'hoch' THEN 3 ELSE 0 END"
_STAND_INS = ", ".join(f"'{s}'" for s in survivors.STAND_INS)
_MEMBERS = f"""
  listed AS (SELECT DISTINCT group_id, {_LEVEL.format('confidence')} AS conf, unnest(concept_ids) AS concept_id FROM merge_groups),
  known AS (SELECT l.* FROM listed l SEMI JOIN concept_records r ON l.concept_id = r.concept_id),
  sets AS (SELECT group_id, conf, string_agg(concept_id, '|' ORDER BY concept_id) AS ids, count(*) AS n FROM known GROUP BY ALL HAVING count(*) > 1),
  chosen AS (SELECT ids, arg_min(group_id, struct_pack(a := -conf, b := group_id)) AS group_id FROM sets GROUP BY ids),
  members AS (SELECT c.group_id, unnest(string_split(c.ids, '|')) AS concept_id FROM chosen c)
"""

# Currency reasoning only decides between members that quality and time leave equal; the SQL follows it by a recursive
# walk over the learned precedences inside each group.
_CURRENCY = f"""
WITH RECURSIVE {_MEMBERS},
  recs AS (SELECT concept_id, {_LEVEL.format('quality')} AS q, updated_at, mention_count, title, subtype, description, home, resource_url FROM concept_records),
  long AS (UNPIVOT (SELECT m.group_id, r.* FROM members m JOIN recs r USING (concept_id)) ON title, subtype, description, home, resource_url INTO NAME field_name VALUE v),
  vals AS (SELECT * FROM long WHERE lower(trim(v)) NOT IN ({_STAND_INS})),
  lagged AS (SELECT field_name, lag(v) OVER (PARTITION BY group_id, field_name ORDER BY updated_at, concept_id) AS e, v AS l FROM vals WHERE updated_at IS NOT NULL),
  steps AS (SELECT field_name, e, l, count(*) AS n FROM lagged WHERE e <> l GROUP BY ALL),
  learned AS (SELECT s.field_name, s.e, s.l FROM steps s LEFT JOIN steps t ON t.field_name = s.field_name AND t.e = s.l AND t.l = s.e WHERE s.n > coalesce(t.n, 0)),
  opened AS (SELECT DISTINCT group_id, field_name FROM vals WHERE updated_at IS NULL),
  gv AS (SELECT DISTINCT v.group_id, v.field_name, v.v FROM vals v JOIN opened o USING (group_id, field_name)),
  ge AS (SELECT a.group_id, a.field_name, d.e, d.l FROM gv a JOIN learned d ON d.field_name = a.field_name AND d.e = a.v
         JOIN gv b ON b.group_id = a.group_id AND b.field_name = a.field_name AND b.v = d.l),
  walk(group_id, field_name, v, depth) AS (SELECT DISTINCT group_id, field_name, e, 0 FROM ge
         UNION SELECT w.group_id, w.field_name, g.l, w.depth + 1 FROM walk w JOIN ge g ON g.group_id = w.group_id AND g.field_name = w.field_name AND g.e = w.v WHERE w.depth < 12),
  depths AS (SELECT group_id, field_name, v, max(depth) AS depth FROM walk GROUP BY ALL)"""

ORACLE: dict[str, str] = {
    "p5_latest": _CURRENCY + """
SELECT group_id, field_name, concept_id, v AS value, depth FROM (SELECT v.*, coalesce(d.depth, 0) AS depth, row_number() OVER (PARTITION BY group_id, field_name
    ORDER BY coalesce(d.depth, 0) DESC, q DESC, updated_at DESC NULLS LAST, mention_count DESC NULLS LAST, concept_id) AS rn
  FROM vals v JOIN opened o USING (group_id, field_name) LEFT JOIN depths d USING (group_id, field_name, v)) WHERE rn = 1""",
    "p5_survivors": _CURRENCY + """,
  ranked AS (SELECT v.group_id, v.field_name, v.v, row_number() OVER (PARTITION BY v.group_id, v.field_name
               ORDER BY v.q DESC, v.updated_at DESC NULLS LAST, coalesce(d.depth, 0) DESC, v.mention_count DESC NULLS LAST, v.concept_id) AS rn
             FROM vals v LEFT JOIN depths d USING (group_id, field_name, v)),
  lead AS (SELECT m.group_id, r.concept_id AS v, row_number() OVER (PARTITION BY m.group_id
             ORDER BY r.q DESC, r.updated_at DESC NULLS LAST, r.mention_count DESC NULLS LAST, r.concept_id) AS rn FROM members m JOIN recs r USING (concept_id)),
  best AS (SELECT group_id, field_name, v FROM ranked WHERE rn = 1 UNION ALL SELECT group_id, 'canonical', v FROM lead WHERE rn = 1)
SELECT group_id, max(v) FILTER (field_name = 'canonical') AS canonical, max(v) FILTER (field_name = 'title') AS title, max(v) FILTER (field_name = 'subtype') AS subtype,
  max(v) FILTER (field_name = 'description') AS description, max(v) FILTER (field_name = 'home') AS home, max(v) FILTER (field_name = 'resource_url') AS resource_url
FROM best GROUP BY group_id""",
    "p6_found": """
WITH RECURSIVE listed AS (SELECT DISTINCT group_id, unnest(concept_ids) AS id FROM merge_groups),
  grouped AS (SELECT l.* FROM listed l SEMI JOIN concept_records r ON l.id = r.concept_id),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY session_id, candidate_index
               ORDER BY judged_at DESC NULLS LAST, (same_entity IS NOT NULL) DESC, same_entity DESC NULLS LAST) AS rn FROM adjudications),
  judged AS (SELECT new_id AS a, existing_id AS b FROM ranked WHERE rn = 1 AND same_entity
               AND new_id IN (SELECT concept_id FROM concept_records) AND existing_id IN (SELECT concept_id FROM concept_records)),
  hubs AS (SELECT id AS a, min(id) OVER (PARTITION BY group_id) AS b FROM grouped),
  edges AS (SELECT a, b FROM hubs WHERE a <> b UNION SELECT b, a FROM hubs WHERE a <> b
            UNION SELECT a, b FROM judged WHERE a <> b UNION SELECT b, a FROM judged WHERE a <> b),
  reach(id, k) AS (SELECT a, a FROM edges UNION SELECT e.b, r.k FROM reach r JOIN edges e ON e.a = r.id WHERE r.k < e.b OR r.k <> e.b)
SELECT id AS concept_id, min(k) AS group_key FROM reach GROUP BY id""",
    "p5_found": f"""
WITH RECURSIVE {_MEMBERS},
  recs AS (SELECT concept_id, {_LEVEL.format('quality')} AS q, updated_at, mention_count, title, subtype, description, home, resource_url FROM concept_records),
  long AS (UNPIVOT (SELECT m.group_id, r.* FROM members m JOIN recs r USING (concept_id)) ON title, subtype, description, home, resource_url INTO NAME field_name VALUE v),
  vals AS (SELECT * FROM long WHERE lower(trim(v)) NOT IN ({_STAND_INS})),
  lagged AS (SELECT field_name, lag(v) OVER (PARTITION BY group_id, field_name ORDER BY updated_at, concept_id) AS e, v AS l FROM vals WHERE updated_at IS NOT NULL),
  steps AS (SELECT field_name, e, l, count(*) AS n FROM lagged WHERE e <> l GROUP BY ALL),
  learned AS (SELECT s.field_name, s.e, s.l FROM steps s LEFT JOIN steps t ON t.field_name = s.field_name AND t.e = s.l AND t.l = s.e WHERE s.n > coalesce(t.n, 0)),
  opened AS (SELECT DISTINCT group_id, field_name FROM vals WHERE updated_at IS NULL),
  gv AS (SELECT DISTINCT v.group_id, v.field_name, v.v FROM vals v JOIN opened o USING (group_id, field_name)),
  ge AS (SELECT a.group_id, a.field_name, d.e, d.l FROM gv a JOIN learned d ON d.field_name = a.field_name AND d.e = a.v
         JOIN gv b ON b.group_id = a.group_id AND b.field_name = a.field_name AND b.v = d.l),
  walk(group_id, field_name, v, depth) AS (SELECT DISTINCT group_id, field_name, e, 0 FROM ge
         UNION SELECT w.group_id, w.field_name, g.l, w.depth + 1 FROM walk w JOIN ge g ON g.group_id = w.group_id AND g.field_name = w.field_name AND g.e = w.v WHERE w.depth < 12),
  depths AS (SELECT group_id, field_name, v, max(depth) AS depth FROM walk GROUP BY ALL),
  ranked AS (SELECT v.group_id, v.field_name, v.concept_id, row_number() OVER (PARTITION BY v.group_id, v.field_name
               ORDER BY v.q DESC, v.updated_at DESC NULLS LAST, coalesce(d.depth, 0) DESC, v.mention_count DESC NULLS LAST, v.concept_id) AS rn
             FROM vals v LEFT JOIN depths d USING (group_id, field_name, v)),
  lead AS (SELECT m.group_id, r.concept_id, row_number() OVER (PARTITION BY m.group_id
             ORDER BY r.q DESC, r.updated_at DESC NULLS LAST, r.mention_count DESC NULLS LAST, r.concept_id) AS rn FROM members m JOIN recs r USING (concept_id))
SELECT group_id, field_name, concept_id FROM ranked WHERE rn = 1
UNION ALL SELECT group_id, 'canonical', concept_id FROM lead WHERE rn = 1""",
}
