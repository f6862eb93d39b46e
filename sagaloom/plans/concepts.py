"""Queries on concept documents, links, ledgers and checks, each with the SQL it is checked against. SURVEY ids stand beside each query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sagaloom.functions import texts
from sagaloom.functions.names import filled, fold, long_words, without_gloss
from sagaloom.operators import concepts, graphs, linking
from sagaloom.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
GENERIC = ["wache", "bote", "wirt"]
MOMENTS = ("2024-01-01", "2024-07-01")


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return register


FRONT = "starts_with(text, '---' || chr(10)) AND contains(substr(text, 4), chr(10) || '---' || chr(10))"


@query(f"""WITH p AS (SELECT doc_id, text, CASE WHEN {FRONT} THEN strpos(substr(text, 4), chr(10) || '---' || chr(10)) ELSE 0 END AS pos FROM documents)
SELECT doc_id, pos > 0 AS has_front, CASE WHEN pos > 1 THEN substr(text, 5, pos - 1) WHEN text IS NOT NULL THEN '' END AS front, trim(CASE WHEN pos > 0 THEN substr(text, pos + 8) ELSE text END, ' ' || chr(9) || chr(10) || chr(13)) AS body FROM p""")
def split_documents(spark, folder):  # A5 A6: the two halves; YAML itself is not read
    t = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", F.coalesce(texts.has_front_matter(t), F.lit(False)).alias("has_front"), texts.front_matter(t).alias("front"), F.btrim(texts.body(t), F.lit(texts.BLANKS)).alias("body")
    )


LINKS = r"(SELECT doc_id, unnest(regexp_extract_all(text, '\[([^\[\]]*)\]\(([^()\s]+\.md)(?:#[^()\s]*)?\)', 1)) AS label, unnest(regexp_extract_all(text, '\[([^\[\]]*)\]\(([^()\s]+\.md)(?:#[^()\s]*)?\)', 2)) AS target FROM documents)"


@query(f"SELECT doc_id, label, target FROM {LINKS} WHERE NOT contains(target, '://')")
def extract_links(spark, folder):  # J6
    return concepts.link_table(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")


@query(f"SELECT target, count(*) AS n_links, count(DISTINCT doc_id) AS n_documents FROM {LINKS} WHERE NOT contains(target, '://') GROUP BY 1")
def inbound_counts(spark, folder):  # E16 without its restriction to event pages
    return concepts.inbound(extract_links(spark, folder))


@query(f"""SELECT l.doc_id, l.label, l.target FROM {LINKS} l WHERE NOT contains(target, '://') AND NOT EXISTS (SELECT 1 FROM entities e WHERE '/' || e.concept_id || '.md' = l.target)""")
def broken_links(spark, folder):  # E10: links whose target does not exist
    known = table(spark, folder, "entities").select(F.concat(F.lit("/"), "concept_id", F.lit(".md")).alias("target")).distinct()
    return extract_links(spark, folder).join(known, "target", "left_anti").select("doc_id", "label", "target")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
 h AS (SELECT *, last_value(CASE WHEN regexp_matches(line, '^#+ ') THEN trim(regexp_replace(line, '^#+ ', '')) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS heading FROM l)
SELECT doc_id, line_no::INT AS line_no, coalesce(heading, '') AS heading, trim(substr(line, 3)) AS bullet FROM h WHERE regexp_matches(line, '^[-*] ')""")
def section_bullets(spark, folder):  # J9, and of J7 the nearest heading
    return concepts.section_bullets(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")


@query("""SELECT concept_id, canonical_name FROM entities WHERE lower(entity_type) = 'npc' AND list_contains(aliases, canonical_name) IS DISTINCT FROM true
 AND (created_at IS NULL OR created_at <= TIMESTAMP '2024-01-01') AND (retired_at IS NULL OR retired_at > TIMESTAMP '2024-01-01')""")
def concept_filter(spark, folder):  # C1 type and as_of
    rows = table(spark, folder, "entities").filter((F.lower("entity_type") == "npc") & ~F.coalesce(F.array_contains("aliases", F.col("canonical_name")), F.lit(False)))
    return concepts.alive_at(rows, F.lit(MOMENTS[0]).cast("timestamp_ntz")).select("concept_id", "canonical_name")


@query("SELECT coalesce(entity_type, 'all') AS type_name, count(*) AS n_concepts, max(created_at) AS newest, grouping(entity_type) AS is_total FROM entities GROUP BY GROUPING SETS ((entity_type), ())")
def concept_counts(spark, folder):  # E6 E7
    e = table(spark, folder, "entities", "entity_type", "created_at")
    return e.rollup("entity_type").agg(F.count("*").alias("n_concepts"), F.max("created_at").alias("newest"), F.grouping("entity_type").cast("long").alias("is_total")).select(
        F.coalesce("entity_type", F.lit("all")).alias("type_name"), "n_concepts", "newest", "is_total"
    )


@query("""WITH b AS (SELECT concept_id FROM entities WHERE (created_at IS NULL OR created_at <= TIMESTAMP '2024-01-01') AND (retired_at IS NULL OR retired_at > TIMESTAMP '2024-01-01')),
 a AS (SELECT concept_id FROM entities WHERE (created_at IS NULL OR created_at <= TIMESTAMP '2024-07-01') AND (retired_at IS NULL OR retired_at > TIMESTAMP '2024-07-01')),
 c AS (SELECT (SELECT count(*) FROM b) AS n_before, (SELECT count(*) FROM b WHERE concept_id NOT IN (SELECT concept_id FROM a)) AS n_lost, (SELECT count(*) FROM a WHERE concept_id NOT IN (SELECT concept_id FROM b)) AS n_new)
SELECT *, n_before >= 20 AND n_lost > 0.02 * n_before AS refused FROM c""")
def rename_guard(spark, folder):  # E24 E23 S3
    e = table(spark, folder, "entities", "concept_id", "created_at", "retired_at")
    before, after = (concepts.alive_at(e, F.lit(m).cast("timestamp_ntz")) for m in MOMENTS)
    return concepts.rename_guard(before, after, "concept_id")


@query("""WITH u AS (SELECT * FROM thread_updates WHERE thread_id IS NOT NULL AND lower(trim(thread_id)) <> 'neu' AND session_id IS NOT NULL),
 s AS (SELECT thread_id, min(session_id) AS opened, max(session_id) AS last_session, count(*) AS n_steps FROM u GROUP BY 1),
 t AS (SELECT thread_id, session_id, update_id, lower(trim(thread_status)) AS status FROM u WHERE trim(coalesce(thread_status, '')) <> ''),
 r AS (SELECT *, lag(status) OVER (PARTITION BY thread_id ORDER BY session_id, update_id) AS b FROM t),
 l AS (SELECT thread_id, status, session_id, row_number() OVER (PARTITION BY thread_id ORDER BY session_id DESC, update_id DESC) AS rn FROM r WHERE b IS NULL OR b <> status)
SELECT s.thread_id, opened, last_session, coalesce(l.status, 'open') AS status, CASE WHEN l.status <> 'open' THEN l.session_id END AS closed, n_steps FROM s LEFT JOIN l ON l.thread_id = s.thread_id AND rn = 1""")
def ledger_fold_sql(spark, folder):  # of L1 the state of known ids, L2; no minting of new threads
    return concepts.thread_ledger(table(spark, folder, "thread_updates"))


@query("""WITH u AS (SELECT thread_id, session_id, update_id, lower(trim(thread_status)) AS status FROM thread_updates WHERE thread_id IS NOT NULL AND lower(trim(thread_id)) <> 'neu' AND session_id IS NOT NULL AND trim(coalesce(thread_status, '')) <> '')
SELECT thread_id FROM (SELECT thread_id, status, row_number() OVER (PARTITION BY thread_id ORDER BY session_id DESC, update_id DESC) AS rn FROM u) WHERE rn = 1 AND status = 'open'""")
def open_threads(spark, folder):  # L3
    return concepts.thread_ledger(table(spark, folder, "thread_updates")).filter("status = 'open'").select("thread_id")


@query("""WITH m AS (SELECT entity_name, session_id, change_id, status_value, row_number() OVER w AS rn, lag(status_value) OVER w AS b FROM status_changes WHERE entity_name IS NOT NULL WINDOW w AS (PARTITION BY entity_name ORDER BY session_id, change_id)),
 s AS (SELECT *, row_number() OVER (PARTITION BY entity_name ORDER BY session_id DESC, change_id DESC) AS k FROM m WHERE rn = 1 OR b IS DISTINCT FROM status_value)
SELECT entity_name, status_value, session_id AS since FROM s WHERE k = 1""")
def since_first_of_run(spark, folder):  # F14
    rows = table(spark, folder, "status_changes", "entity_name", "session_id", "change_id", "status_value").filter("entity_name is not null")
    return concepts.since(rows.dropDuplicates(["entity_name", "session_id", "change_id"]), ["entity_name"], ["session_id", "change_id"], "status_value", "session_id")


@query("""WITH n AS (SELECT entity_type, lower(title) AS k FROM concept_records WHERE trim(coalesce(title, '')) <> '' AND entity_type IS NOT NULL), g AS (SELECT k, entity_type, count(*) AS n FROM n GROUP BY ALL),
 t AS (SELECT coalesce(sum(n * (n - 1) // 2), 0)::BIGINT AS same FROM g), e AS (SELECT coalesce(sum(n * (n - 1) // 2), 0)::BIGINT AS every FROM (SELECT k, sum(n) AS n FROM g GROUP BY 1))
SELECT 'same_kind' AS check_name, same AS n_pairs FROM t UNION ALL SELECT 'other_kind', every - same FROM t, e""")
def name_pair_counts(spark, folder):  # N1 N2 as counts
    r = table(spark, folder, "concept_records", "entity_type", "title").filter((F.length(F.trim("title")) > 0) & F.col("entity_type").isNotNull())
    return concepts.pair_counts(r.select("entity_type", F.lower("title").alias("k")), "k", "entity_type")


@query("""WITH l AS (SELECT DISTINCT group_id, unnest(concept_ids) AS concept_id FROM merge_groups), f AS (SELECT DISTINCT new_id AS a, existing_id AS b FROM adjudications WHERE same_entity = false AND new_id <> existing_id),
 x AS (SELECT DISTINCT p.group_id FROM f JOIN l p ON p.concept_id = f.a JOIN l q ON q.group_id = p.group_id AND q.concept_id = f.b)
SELECT group_id, concept_id FROM l WHERE concept_id IS NOT NULL AND group_id NOT IN (SELECT group_id FROM x)""")
def never_merge_antijoin(spark, folder):  # D11 with forbidden pairs
    rows = table(spark, folder, "merge_groups").select("group_id", F.explode("concept_ids").alias("concept_id")).filter("concept_id is not null")
    forbidden = table(spark, folder, "adjudications").filter("same_entity = false and new_id != existing_id").select(F.col("new_id").alias("a"), F.col("existing_id").alias("b")).distinct()
    return concepts.without_forbidden(rows, forbidden, "group_id", "concept_id")


@query("""WITH o AS (SELECT doc_id, rater, max(abusive) AS v FROM doc_labels WHERE abusive IS NOT NULL AND rater IS NOT NULL GROUP BY 1, 2)
SELECT a.rater AS rater_a, b.rater AS rater_b, count(*) AS n_both, count(*) FILTER (a.v = b.v) AS n_same FROM o a JOIN o b ON a.doc_id = b.doc_id AND a.rater < b.rater GROUP BY 1, 2""")
def judge_agreement(spark, folder):  # of E34 the counts
    return concepts.agreement(table(spark, folder, "doc_labels"), "doc_id", "rater", "abusive")


@query("""WITH p AS (SELECT coalesce(candidate_kind, '') AS kind_name, session_id, candidate_index, bool_or(same_entity) AS truth, max(ratio) AS ratio FROM adjudications GROUP BY 1, 2, 3 HAVING bool_or(same_entity) IS NOT NULL),
 c AS (SELECT kind_name, count(*) FILTER (ratio >= 0.85 AND truth) AS tp, count(*) FILTER (ratio >= 0.85 AND NOT truth) AS fp, count(*) FILTER (truth AND NOT coalesce(ratio >= 0.85, false)) AS fn FROM p GROUP BY 1)
SELECT *, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) END AS precision_share, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) END AS recall_share FROM c""")
def precision_recall(spark, folder):  # E25 on candidate verdicts
    a = table(spark, folder, "adjudications").groupBy(F.coalesce("candidate_kind", F.lit("")).alias("kind_name"), "session_id", "candidate_index").agg(F.bool_or("same_entity").alias("truth"), F.max("ratio").alias("ratio"))
    n = lambda c: F.count(F.when(c, 1))
    hit, truth = F.coalesce(F.col("ratio") >= 0.85, F.lit(False)), F.col("truth")
    c = a.filter("truth is not null").groupBy("kind_name").agg(n(hit & truth).alias("tp"), n(hit & ~truth).alias("fp"), n(~hit & truth).alias("fn"))
    share = lambda x, y: F.when(F.col(x) + F.col(y) > 0, F.round(F.col(x) / (F.col(x) + F.col(y)), 6))
    return c.select("*", share("tp", "fp").alias("precision_share"), share("tp", "fn").alias("recall_share"))


@query("""SELECT 'no_session' AS check_name, count(*) AS n_violations FROM attitude_changes WHERE trim(coalesce(session_id, '')) = ''
UNION ALL SELECT 'no_evidence', count(*) FROM attitude_changes WHERE trim(coalesce(evidence, '')) = ''
UNION ALL SELECT 'no_citation', count(*) FROM attitude_changes WHERE trim(coalesce(citation_ts, '')) = ''
UNION ALL SELECT 'session_mismatch', count(*) FROM attitude_changes WHERE session_date <> substr(session_id, 1, 10)
UNION ALL SELECT 'self_loop', count(*) FROM attitude_changes WHERE entity_name = toward
UNION ALL SELECT 'both_ways', count(*) FROM (SELECT DISTINCT entity_name AS a, toward AS b FROM attitude_changes WHERE entity_name < toward) x JOIN (SELECT DISTINCT toward AS a, entity_name AS b FROM attitude_changes) y USING (a, b)
UNION ALL SELECT 'unlinked_thread', count(*) FROM thread_updates WHERE coalesce(len(involves), 0) = 0""")
def edge_checks(spark, folder):  # N3 N5 N10 N11 N18, C14: the attitudes as edges
    a = table(spark, folder, "attitude_changes")
    blank = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) == 0
    ways = a.select(F.col("entity_name").alias("a"), F.col("toward").alias("b"))
    return graphs.constraint_counts({
        "no_session": a.filter(blank("session_id")), "no_evidence": a.filter(blank("evidence")), "no_citation": a.filter(blank("citation_ts")),
        "session_mismatch": a.filter(F.col("session_date") != F.substring("session_id", 1, 10)), "self_loop": a.filter("entity_name = toward"),
        "both_ways": ways.filter("a < b").distinct().join(ways.select(F.col("b").alias("a"), F.col("a").alias("b")).distinct(), ["a", "b"]),
        "unlinked_thread": table(spark, folder, "thread_updates", "involves").filter(F.coalesce(F.size("involves"), F.lit(0)) <= 0),
    })


@query("""SELECT mention_id, array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(coalesce(mention_name, ''), '[\\p{L}\\p{N}_]+'), lambda x: length(x) >= 4), lambda x: lower(x)))), ' ') AS tokens,
 regexp_full_match(list_extract(string_split_regex(lower(trim(coalesce(mention_name, ''))), '\\s+'), -1), '[0-9]+') OR len(list_filter(string_split_regex(lower(trim(coalesce(mention_name, ''))), '\\s+'), lambda w: contains(w, 'wache') OR contains(w, 'bote') OR contains(w, 'wirt'))) > 0 AS is_generic FROM mentions""")
def mention_words(spark, folder):  # Q14 C10, the terms being a parameter
    name = F.coalesce("mention_name", F.lit(""))
    return table(spark, folder, "mentions").select("mention_id", F.array_join(long_words(name), " ").alias("tokens"), texts.is_generic(name, GENERIC).alias("is_generic"))


@query("""SELECT group_id, CASE lower(trim(confidence)) WHEN 'hoch' THEN 'high' WHEN 'niedrig' THEN 'low' ELSE 'medium' END AS level_name, nullif(regexp_replace(proposed_by, '[^A-Za-z0-9_]', '', 'g'), '') AS proposer, 'c_' || substr(sha256(canonical), 1, 8) AS canonical_uid FROM merge_groups""")
def group_labels(spark, folder):  # I38 I39 I37, a hash in place of a random number
    return table(spark, folder, "merge_groups").select("group_id", texts.confidence(F.col("confidence")).alias("level_name"), texts.sanitized_label(F.col("proposed_by")).alias("proposer"), texts.minted_uid(F.col("canonical")).alias("canonical_uid"))


@query("""SELECT concept_id, regexp_extract(resource_url, '(?:[?&]v=|youtu\\.be/)([A-Za-z0-9_\\-]{6,})', 1) AS video, resource_url || CASE WHEN contains(resource_url, '?') THEN '&t=' ELSE '?t=' END || mention_count || 's' AS address_at FROM concept_records WHERE resource_url IS NOT NULL""")
def media_addresses(spark, folder):  # I15 I16
    r = table(spark, folder, "concept_records").filter("resource_url is not null")
    return r.select("concept_id", texts.video_id(F.col("resource_url")).alias("video"), texts.address_at(F.col("resource_url"), F.col("mention_count")).alias("address_at"))


@query("""SELECT concept_id, array_to_string(list_sort(string_split(regexp_replace(concept_id, '^.*/', ''), '_')), '_') AS sorted_slug,
 array_to_string(CASE WHEN regexp_matches(s, '^(der|die|das)_') THEN [regexp_replace(s, '^(der|die|das)_', '')] ELSE ['der_' || s, 'die_' || s, 'das_' || s] END, ' ') AS variants FROM (SELECT concept_id, regexp_replace(concept_id, '^.*/', '') AS s FROM entities)""")
def slug_variants(spark, folder):  # I2 I40
    s = F.regexp_replace("concept_id", "^.*/", "")
    return table(spark, folder, "entities").select("concept_id", F.array_join(F.array_sort(F.split(s, "_")), "_").alias("sorted_slug"), F.array_join(texts.article_variants(s), " ").alias("variants"))


@query("""SELECT segment_id, printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) || ' ' || coalesce(nullif(trim(speaker), ''), '?') || ': ' || trim(text) AS line FROM (SELECT *, round_even(start_s, 0)::BIGINT AS s FROM segments WHERE start_s >= 0 AND trim(coalesce(text, '')) <> '')""")
def render_dialogue(spark, folder):  # I29 I30, one line per segment, times rounded half to even
    r = table(spark, folder, "segments", "segment_id", "start_s", "speaker", "text").filter((F.col("start_s") >= 0) & (F.length(F.trim("text")) > 0))
    who = F.coalesce(F.nullif(F.trim("speaker"), F.lit("")), F.lit("?"))
    return r.select("segment_id", F.concat(texts.rendered_time(F.col("start_s")), F.lit(" "), who, F.lit(": "), F.trim("text")).alias("line"))


@query("SELECT session_id, dense_rank() OVER (ORDER BY session_id) AS ordinal, dense_rank() OVER (ORDER BY session_id DESC) <= 5 AS is_recent FROM (SELECT DISTINCT session_id FROM segments WHERE session_id IS NOT NULL)")
def session_ordinals(spark, folder):  # F1 H1
    # one row per session, the only rows that come together
    s = table(spark, folder, "segments", "session_id").filter("session_id is not null").distinct()
    up, down = Window.orderBy("session_id"), Window.orderBy(F.desc("session_id"))
    return s.select("session_id", F.row_number().over(up).alias("ordinal"), (F.row_number().over(down) <= 5).alias("is_recent"))


@query("""WITH g AS (SELECT mention_id, lower(trim(mention_name)) AS a, nullif(trim(regexp_replace(lower(trim(mention_name)), '\\s*(\\([^()]*\\)|\\[[^\\[\\]]*\\])\\s*$', '')), '') AS b FROM mentions),
 c AS (SELECT lower(trim(canonical_name)) AS k, CASE WHEN count(DISTINCT concept_id) = 1 THEN min(concept_id) END AS v FROM entities GROUP BY 1),
 al AS (SELECT lower(trim(x)) AS k, CASE WHEN count(DISTINCT concept_id) = 1 THEN min(concept_id) END AS v FROM (SELECT concept_id, unnest(aliases) AS x FROM entities) WHERE trim(coalesce(x, '')) <> '' GROUP BY 1)
SELECT mention_id, CASE WHEN c.k IS NOT NULL THEN c.v WHEN al.k IS NOT NULL THEN al.v WHEN c2.k IS NOT NULL THEN c2.v WHEN a2.k IS NOT NULL THEN a2.v END AS ref_id,
 CASE WHEN c.k IS NOT NULL THEN CASE WHEN c.v IS NULL THEN 'ambiguous' ELSE 'canonical' END WHEN al.k IS NOT NULL THEN CASE WHEN al.v IS NULL THEN 'ambiguous' ELSE 'alias' END
 WHEN c2.k IS NOT NULL THEN CASE WHEN c2.v IS NULL THEN 'ambiguous' ELSE 'canonical, no gloss' END WHEN a2.k IS NOT NULL THEN CASE WHEN a2.v IS NULL THEN 'ambiguous' ELSE 'alias, no gloss' END ELSE 'absent' END AS step
FROM g LEFT JOIN c ON c.k = g.a LEFT JOIN al ON al.k = g.a LEFT JOIN c c2 ON c2.k = g.b LEFT JOIN al a2 ON a2.k = g.b""")
def name_index_resolve(spark, folder):  # of D17 and D18 the exact and the gloss steps, ambiguity as null; no slug, basename, compact or prefix step
    e = table(spark, folder, "entities", "concept_id", "canonical_name", "aliases")
    canon = e.select(fold(F.col("canonical_name")).alias("k"), F.col("concept_id").alias("v"))
    alias = e.select("concept_id", F.explode("aliases").alias("x")).filter(filled(F.col("x"))).select(fold(F.col("x")).alias("k"), F.col("concept_id").alias("v"))
    whole = fold(F.col("mention_name"))
    bare = F.nullif(without_gloss(whole), F.lit(""))
    steps = [("canonical", canon, whole), ("alias", alias, whole), ("canonical, no gloss", canon, bare), ("alias, no gloss", alias, bare)]
    return linking.resolve_names(table(spark, folder, "mentions", "mention_id", "mention_name"), steps, "ref_id").select("mention_id", "ref_id", "step")
