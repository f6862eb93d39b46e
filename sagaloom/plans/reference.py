"""Queries of the reference's operators over the campaign tables, each with the SQL it is checked against.

SURVEY ids of the operators stand beside each query; where a query does only a part, the part is named.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sagaloom.functions.names import clock, filled, fold, media_seconds, slug
from sagaloom.operators import graphs, linking, temporal
from sagaloom.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


WORDS = "len(string_split_regex(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '))"


def _word_count(c):
    return F.size(F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " "))


@query(f"""WITH s AS (SELECT session_id, speaker, {WORDS} AS w FROM segments WHERE trim(coalesce(text, '')) <> ''),
 a AS (SELECT session_id, sum(w)::BIGINT AS n_words, coalesce(sum(w) FILTER (starts_with(speaker, 'SPEAKER_')), 0)::BIGINT AS n_unmapped FROM s GROUP BY 1)
SELECT *, round(n_unmapped / n_words, 6) AS unmapped_ratio, CASE WHEN n_unmapped / n_words < 0.05 THEN 'hoch' WHEN n_unmapped / n_words < 0.2 THEN 'mittel' ELSE 'niedrig' END AS quality FROM a""")
def session_word_stats(spark, folder):  # E1 E2 C6
    s = table(spark, folder, "segments", "session_id", "speaker", "text").filter(F.length(F.trim("text")) > 0).withColumn("w", _word_count(F.col("text")))
    a = s.groupBy("session_id").agg(F.sum("w").cast("long").alias("n_words"), F.coalesce(F.sum(F.when(F.col("speaker").startswith("SPEAKER_"), F.col("w"))), F.lit(0)).cast("long").alias("n_unmapped"))
    r = F.col("n_unmapped") / F.col("n_words")
    return a.select("*", F.round(r, 6).alias("unmapped_ratio"), F.when(r < 0.05, "hoch").when(r < 0.2, "mittel").otherwise("niedrig").alias("quality"))


@query("""SELECT concept_id, trim(regexp_replace(lower(replace(replace(replace(replace(replace(replace(replace(canonical_name,'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss'),'Ä','Ae'),'Ö','Oe'),'Ü','Ue')), '[^a-z0-9]+', '_', 'g'), '_') AS name_slug FROM entities""")
def slugify_names(spark, folder):  # I1
    return table(spark, folder, "entities").select("concept_id", slug(F.col("canonical_name")).alias("name_slug"))


@query("""WITH t AS (SELECT mention_id, CASE WHEN regexp_full_match(trim(citation_ts), '\\d{1,3}:[0-5]?\\d:[0-5]?\\d') THEN split_part(trim(citation_ts),':',1)::INT*3600+split_part(trim(citation_ts),':',2)::INT*60+split_part(trim(citation_ts),':',3)::INT
 WHEN regexp_full_match(trim(citation_ts), '\\d{1,3}:[0-5]?\\d') THEN split_part(trim(citation_ts),':',1)::INT*60+split_part(trim(citation_ts),':',2)::INT END AS seconds FROM mentions)
SELECT mention_id, seconds, printf('%02d:%02d:%02d', seconds // 3600, seconds // 60 % 60, seconds % 60) AS rendered FROM t WHERE seconds IS NOT NULL""")
def parse_timestamps(spark, folder):  # I31 I30
    s = media_seconds(F.col("citation_ts"))
    return table(spark, folder, "mentions").select("mention_id", s.alias("seconds"), clock(s).alias("rendered")).filter("seconds is not null")


@query("""SELECT entity_type, CASE WHEN important OR n >= 5 OR (n >= 2 AND entity_type IN ('Character','Deity')) THEN 'deep' WHEN n >= 2 OR entity_type IN ('Character','Deity','Domain','Faction') THEN 'standard' ELSE 'brief' END AS tier, count(*) AS n_concepts
FROM (SELECT e.entity_type, coalesce(e.important, false) AS important, count(m.mention_id) AS n FROM entities e LEFT JOIN mentions m ON m.mention_name = e.canonical_name GROUP BY e.concept_id, 1, 2) GROUP BY 1, 2""")
def tier_counts(spark, folder):  # C5 E5
    e = table(spark, folder, "entities", "concept_id", "entity_type", "canonical_name", "important")
    m = table(spark, folder, "mentions", "mention_name").groupBy("mention_name").agg(F.count("*").alias("n"))
    j = e.join(m, F.col("canonical_name") == F.col("mention_name"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    t = F.when(F.coalesce("important", F.lit(False)) | (F.col("n") >= 5) | ((F.col("n") >= 2) & F.col("entity_type").isin("Character", "Deity")), "deep").when((F.col("n") >= 2) | F.col("entity_type").isin("Character", "Deity", "Domain", "Faction"), "standard").otherwise("brief")
    return j.groupBy("entity_type", t.alias("tier")).agg(F.count("*").alias("n_concepts"))


@query("""WITH c AS (SELECT lower(trim(canonical_name)) AS k, min(concept_id) AS v FROM entities GROUP BY 1), a AS (SELECT lower(trim(x)) AS k, min(concept_id) AS v FROM (SELECT concept_id, unnest(aliases) AS x FROM entities) WHERE trim(coalesce(x,'')) <> '' GROUP BY 1)
SELECT mention_id, coalesce(c.v, a.v, 'unresolved') AS ref_id, CASE WHEN c.v IS NOT NULL THEN 'canonical' WHEN a.v IS NOT NULL THEN 'alias' ELSE 'default' END AS step FROM mentions m LEFT JOIN c ON c.k = lower(trim(m.mention_name)) LEFT JOIN a ON a.k = lower(trim(m.mention_name))""")
def routing_cascade(spark, folder):  # two levels, canonical and alias, the smallest id of an ambiguous key; D1 D2 D17 D18 not done
    e = table(spark, folder, "entities", "concept_id", "canonical_name", "aliases")
    canon = e.groupBy(fold(F.col("canonical_name")).alias("k")).agg(F.min("concept_id").alias("v"))
    alias = e.select("concept_id", F.explode("aliases").alias("x")).filter(filled(F.col("x"))).groupBy(fold(F.col("x")).alias("k")).agg(F.min("concept_id").alias("v"))
    rows = table(spark, folder, "mentions", "mention_id", "mention_name")
    return linking.cascade(rows, [("canonical", canon), ("alias", alias)], fold(F.col("mention_name")), "ref_id", F.lit("unresolved")).select("mention_id", "ref_id", "step")


@query("""SELECT session_id, citation_ts, CASE WHEN count(DISTINCT mention_name) = 1 THEN min(mention_name) END AS mention_name, count(DISTINCT mention_name) AS n_values FROM mentions GROUP BY 1, 2""")
def mention_index_ambiguous(spark, folder):  # D4
    return linking.unique_or_null(table(spark, folder, "mentions", "session_id", "citation_ts", "mention_name"), ["session_id", "citation_ts"], "mention_name")


@query("""WITH m AS (SELECT *, CASE WHEN regexp_full_match(citation_ts, '\\d{2}:\\d{2}:\\d{2}') THEN split_part(citation_ts,':',1)::INT*3600+split_part(citation_ts,':',2)::INT*60+split_part(citation_ts,':',3)::INT END AS sec FROM mentions)
SELECT m.mention_id, count(*) AS n_near, count(*) FILTER (contains(s.text, m.mention_name)) AS n_naming FROM m JOIN segments s ON s.session_id = m.session_id AND abs(s.start_s - m.sec) <= 120 GROUP BY 1""")
def grounding_window(spark, folder):  # D12 of citations written HH:MM:SS, as its SQL has it; all of them: grounding_counts
    m = table(spark, folder, "mentions", "mention_id", "session_id", "mention_name", "citation_ts").filter(F.col("citation_ts").rlike(r"^\d{2}:\d{2}:\d{2}$"))
    m = m.withColumn("sec", media_seconds(F.col("citation_ts")).cast("double")).drop("citation_ts").filter("sec is not null")
    s = table(spark, folder, "segments", "session_id", "start_s", "text")
    return linking.within(s, m, ["session_id"], "start_s", "sec", 120.0).groupBy("mention_id").agg(F.count("*").alias("n_near"), F.count(F.when(F.contains("text", F.col("mention_name")), 1)).alias("n_naming"))


@query("""WITH p AS (SELECT *, list_transform(string_split(citation_ts, ':'), lambda x: CASE WHEN regexp_full_match(x, '\\s*[+-]?[0-9]{1,9}\\s*') THEN trim(x)::BIGINT END) AS n FROM mentions),
 m AS (SELECT row_number() OVER () AS i, session_id, coalesce(entity_type, '') AS t, list_transform(list_filter(regexp_extract_all(coalesce(mention_name, ''), '[\\p{L}\\p{N}_]+'), lambda x: length(x) >= 4), lambda x: lower(x)) AS tok,
  CASE len(n) WHEN 2 THEN n[1] * 60 + n[2] WHEN 3 THEN n[1] * 3600 + n[2] * 60 + n[3] END AS sec FROM p),
 hit AS (SELECT m.i, coalesce(bool_or(abs(s.start_s - m.sec) <= 120), false) AS near FROM m JOIN segments s ON s.session_id = m.session_id WHERE len(list_filter(m.tok, lambda x: contains(lower(s.text), x))) > 0 GROUP BY 1),
 k AS (SELECT session_id, unnest(['all', t]) AS type_name, CASE WHEN len(tok) = 0 OR sec IS NULL THEN 'unscorable' WHEN hit.near THEN 'near' WHEN hit.i IS NOT NULL THEN 'elsewhere' ELSE 'nowhere' END AS kind FROM m LEFT JOIN hit USING (i)),
 c AS (SELECT session_id, type_name, count(*) FILTER (kind = 'near') AS near, count(*) FILTER (kind = 'elsewhere') AS elsewhere, count(*) FILTER (kind = 'nowhere') AS nowhere, count(*) FILTER (kind = 'unscorable') AS unscorable FROM k GROUP BY 1, 2)
SELECT *, CASE WHEN near + elsewhere + nowhere > 0 THEN round(near / (near + elsewhere + nowhere), 6) ELSE 0.0::DOUBLE END AS near_ratio FROM c""")
def grounding_counts(spark, folder):  # D12 E8
    return linking.grounding(table(spark, folder, "mentions", "session_id", "mention_name", "entity_type", "citation_ts"), table(spark, folder, "segments", "session_id", "start_s", "text"))


@query("""WITH w AS (SELECT session_id, greatest(start_s - 2, 0) AS lo, start_s + 6 AS hi FROM segments WHERE contains(text, 'Schwierigkeit')),
 m AS (SELECT *, max(hi) OVER (PARTITION BY session_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM w),
 i AS (SELECT *, sum(CASE WHEN lo <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY session_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT session_id, round(min(lo), 3) AS lo, round(max(hi), 3) AS hi FROM i GROUP BY session_id, g""")
def excerpt_windows(spark, folder):  # F6 D13
    w = table(spark, folder, "segments", "session_id", "start_s", "text").filter(F.contains("text", F.lit("Schwierigkeit")))
    w = w.select("session_id", F.greatest(F.col("start_s") - 2, F.lit(0.0)).alias("lo"), (F.col("start_s") + 6).alias("hi"))
    return temporal.merged_intervals(w, ["session_id"], "lo", "hi").select("session_id", F.round("lo", 3).alias("lo"), F.round("hi", 3).alias("hi"))


@query("""WITH t AS (SELECT concept_id, entity_type, string_split(regexp_replace(concept_id, '^[^/]*/', ''), '_') AS tok FROM entities)
SELECT a.entity_type, a.concept_id AS small, b.concept_id AS large FROM t a JOIN t b ON a.entity_type = b.entity_type AND a.concept_id <> b.concept_id
WHERE list_has_all(b.tok, a.tok) AND len(list_distinct(b.tok)) > len(list_distinct(a.tok))""")
def token_subset_pairs(spark, folder):  # D6 S6
    t = table(spark, folder, "entities", "concept_id", "entity_type").withColumn("tok", F.split(F.regexp_replace("concept_id", "^[^/]*/", ""), "_"))
    return linking.strict_subsets(t, "entity_type", "concept_id", "tok")


@query("""SELECT k AS name_key, count(DISTINCT concept_id) AS n_owners FROM (SELECT concept_id, lower(trim(unnest(list_append(coalesce(aliases, []), canonical_name)))) AS k FROM entities) WHERE k <> '' GROUP BY 1 HAVING count(DISTINCT concept_id) > 1
UNION ALL SELECT 'all names', count(DISTINCT k) FROM (SELECT lower(trim(unnest(list_append(coalesce(aliases, []), canonical_name)))) AS k FROM entities) WHERE k <> ''""")
def alias_collisions(spark, folder):  # N16 G16
    none = F.array().cast("array<string>")
    n = table(spark, folder, "entities").select("concept_id", F.explode(F.concat(F.coalesce("aliases", none), F.array("canonical_name"))).alias("x")).filter(filled(F.col("x"))).select("concept_id", fold(F.col("x")).alias("name_key"))
    owned = n.groupBy("name_key").agg(F.countDistinct("concept_id").alias("n_owners"))
    return owned.filter("n_owners > 1").unionByName(owned.agg(F.count("*").alias("n_owners")).select(F.lit("all names").alias("name_key"), "n_owners"))


@query("""SELECT entity_type, lower(title) AS title_key, count(*) AS n_records FROM concept_records WHERE trim(coalesce(title, '')) <> '' GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_titles(spark, folder):  # of E10 only equal titles of a type, as groups; the pairs of N1 not done
    return table(spark, folder, "concept_records", "entity_type", "title").filter(filled(F.col("title"))).groupBy("entity_type", F.lower("title").alias("title_key")).agg(F.count("*").alias("n_records")).filter("n_records > 1")


@query("""WITH s AS (SELECT regexp_replace(concept_id, '^[^/]*/', '') AS s, split_part(concept_id, '/', 1) AS d FROM concept_records) SELECT s AS name_slug, count(DISTINCT d) AS n_kinds FROM s GROUP BY 1 HAVING count(DISTINCT d) > 1""")
def cross_type_slugs(spark, folder):  # of E10 only slugs of several types; the pairs of N2 not done
    s = table(spark, folder, "concept_records", "concept_id").select(F.regexp_replace("concept_id", "^[^/]*/", "").alias("name_slug"), F.split("concept_id", "/")[0].alias("d"))
    return s.groupBy("name_slug").agg(F.countDistinct("d").alias("n_kinds")).filter("n_kinds > 1")


LEDGER = "(SELECT user_id, event_id, ts, event_type, value >= 50 AS observed FROM events)"


@query(f"""SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER w AS pt, lag(observed) OVER w AS po, row_number() OVER w AS rn FROM {LEDGER} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE rn = 1 OR pt IS DISTINCT FROM event_type OR po IS DISTINCT FROM observed""")
def collapsed_runs(spark, folder):  # F4
    e = table(spark, folder, "events").withColumn("observed", F.col("value") >= 50)
    return temporal.collapse_runs(e, ["user_id"], ["ts", "event_id"], ["event_type", "observed"]).select("event_id", "user_id", "event_type")


@query(f"""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(observed, false) DESC, ts DESC, event_id DESC) AS rn FROM {LEDGER}) WHERE rn = 1""")
def current_states(spark, folder):  # F5 F14 L3
    return temporal.current_state(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], F.col("value") >= 50).select("user_id", "event_id", "event_type")


EDGES = "(SELECT l_orderkey AS start_id, l_suppkey AS end_id, l_shipdate AS valid_from, lead(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_suppkey, l_partkey) AS valid_to FROM lineitem)"


def _edges(spark, folder):
    l = table(spark, folder, "lineitem", "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_shipdate")
    return temporal.validity(l, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_suppkey", "l_partkey"], "l_shipdate").select(F.col("l_orderkey").alias("start_id"), F.col("l_suppkey").alias("end_id"), "valid_from", "valid_to")


@query(f"SELECT start_id, end_id, valid_from, valid_to FROM {EDGES}")
def scd2_edges(spark, folder):  # F12 L5 L6
    return _edges(spark, folder)


@query(f"SELECT end_id, count(*) AS n_current FROM {EDGES} WHERE valid_from IS NULL OR valid_to IS NULL GROUP BY 1")
def edges_current(spark, folder):  # G10
    return _edges(spark, folder).filter("valid_from is null or valid_to is null").groupBy("end_id").agg(F.count("*").alias("n_current"))


@query(f"SELECT start_id, end_id FROM {EDGES} WHERE valid_from IS NULL OR (valid_from <= TIMESTAMP '1997-01-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1997-01-01'))")
def edges_as_of(spark, folder):  # G11 L7
    return temporal.as_of(_edges(spark, folder), F.lit("1997-01-01").cast("timestamp_ntz")).select("start_id", "end_id")


@query("""WITH e AS (SELECT o_custkey AS start_id, o_orderkey AS end_id, o_orderstatus AS status FROM orders), seeds AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal > 9000)
SELECT DISTINCT start_id, end_id, status FROM e WHERE status <> 'F' AND (start_id IN (SELECT id FROM seeds) OR end_id IN (SELECT id FROM seeds))""")
def expand_one_hop(spark, folder):  # G9
    e = table(spark, folder, "orders").select(F.col("o_custkey").alias("start_id"), F.col("o_orderkey").alias("end_id"), F.col("o_orderstatus").alias("status"))
    seeds = table(spark, folder, "customer").filter("c_acctbal > 9000").select(F.col("c_custkey").alias("id"))
    return graphs.expand(e, seeds, F.col("status") != "F")


PAIRS = "(SELECT DISTINCT new_id AS start_id, existing_id AS end_id FROM adjudications WHERE new_id IS NOT NULL AND existing_id IS NOT NULL)"


def _pairs(spark, folder):
    return table(spark, folder, "adjudications").select(F.col("new_id").alias("start_id"), F.col("existing_id").alias("end_id")).dropna().distinct()


@query(f"SELECT start_id, end_id, false AS was_mirrored FROM {PAIRS} UNION ALL SELECT end_id, start_id, true FROM {PAIRS} p WHERE NOT EXISTS (SELECT 1 FROM {PAIRS} q WHERE q.start_id = p.end_id AND q.end_id = p.start_id)")
def edge_mirror(spark, folder):  # G5
    return graphs.mirrored(_pairs(spark, folder))


@query(f"SELECT start_id, end_id FROM {PAIRS} p WHERE NOT EXISTS (SELECT 1 FROM {PAIRS} q WHERE q.start_id = p.end_id AND q.end_id = p.start_id)")
def asymmetric_edges(spark, folder):  # D32
    return graphs.asymmetric(_pairs(spark, folder))


@query("""SELECT 'orphan_nodes' AS check_name, count(*) AS n_violations FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'status_vocabulary', count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
UNION ALL SELECT 'missing_type', count(*) FROM mentions WHERE entity_type IS NULL
UNION ALL SELECT 'retired_before_created', count(*) FROM entities WHERE retired_at < created_at
UNION ALL SELECT 'verdict_missing', count(*) FROM adjudications WHERE same_entity IS NULL
UNION ALL SELECT 'impossible_end', count(*) FROM segments WHERE end_s < start_s""")
def constraint_suite(spark, folder):  # N6 N19 and four checks of these tables; E30 N3 N10 N15 not done
    nodes = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    edges = table(spark, folder, "orders").select(F.col("o_custkey").alias("start_id"), F.col("o_orderkey").cast("long").alias("end_id"))
    return graphs.constraint_counts({
        "orphan_nodes": nodes.join(edges.select(F.col("start_id").alias("id")), "id", "left_anti"),
        "status_vocabulary": table(spark, folder, "orders", "o_orderstatus").filter(~F.col("o_orderstatus").isin("O", "F")),
        "missing_type": table(spark, folder, "mentions", "entity_type").filter("entity_type is null"),
        "retired_before_created": table(spark, folder, "entities", "created_at", "retired_at").filter("retired_at < created_at"),
        "verdict_missing": table(spark, folder, "adjudications", "same_entity").filter("same_entity is null"),
        "impossible_end": table(spark, folder, "segments", "start_s", "end_s").filter("end_s < start_s"),
    })


@query("""WITH q AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings WHERE vec_id % 50 = 0),
 s AS (SELECT query_id, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]), 6) AS score FROM embeddings, q WHERE query_id <> vec_id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS vec_rank FROM s) WHERE vec_rank <= 10""")
def vector_topk(spark, folder):  # M3 H2
    v = table(spark, folder, "embeddings", "vec_id", "embedding")
    return graphs.cosine_top_k(v, v.filter("vec_id % 50 = 0"), 10)


@query("""WITH a AS (SELECT doc_id, text FROM documents WHERE created_at < TIMESTAMP '2024-01-01'), b AS (SELECT doc_id, coalesce(text, '') || CASE WHEN doc_id % 7 = 0 THEN '!' ELSE '' END AS text FROM documents WHERE doc_id % 11 <> 0)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'created' WHEN b.doc_id IS NULL THEN 'deleted' ELSE 'updated' END AS change FROM a FULL JOIN b ON a.doc_id = b.doc_id WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR coalesce(a.text, '') <> coalesce(b.text, '')""")
def change_feed(spark, folder):  # L8
    d = table(spark, folder, "documents", "doc_id", "text", "created_at")
    edited = d.filter("doc_id % 11 <> 0").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 7 == 0, "!").otherwise("")).alias("text"))
    return temporal.change_feed(d.filter("created_at < timestamp_ntz '2024-01-01'").select("doc_id", "text"), edited, "doc_id", "text")


@query("""WITH l AS (SELECT thread_id, max(session_id) AS last_session FROM thread_updates WHERE thread_id IS NOT NULL GROUP BY 1), s AS (SELECT DISTINCT session_id FROM thread_updates)
SELECT thread_id, last_session, (SELECT count(*) FROM s WHERE session_id > last_session) AS later_sessions FROM l WHERE (SELECT count(*) FROM s WHERE session_id > last_session) >= 6""")
def dormant_threads(spark, folder):  # F10
    return temporal.dormant(table(spark, folder, "thread_updates", "thread_id", "session_id").dropna(), "thread_id", "session_id", 6)


@query("""SELECT coalesce(a.concept_id, b.concept_id) AS concept_id, CASE WHEN a.concept_id IS NULL THEN 'records only' WHEN b.concept_id IS NULL THEN 'entities only' ELSE 'both' END AS side FROM (SELECT DISTINCT concept_id FROM entities) a FULL JOIN (SELECT DISTINCT concept_id FROM concept_records) b USING (concept_id)""")
def funnel_full_outer(spark, folder):  # D21 S5
    a = table(spark, folder, "entities", "concept_id").distinct().withColumn("x", F.lit(1))
    b = table(spark, folder, "concept_records", "concept_id").distinct().withColumn("y", F.lit(1))
    return a.join(b, "concept_id", "full_outer").select("concept_id", F.when(F.col("x").isNull(), "records only").when(F.col("y").isNull(), "entities only").otherwise("both").alias("side"))


@query("""SELECT 'status' AS action_kind, change_id AS action_id, entity_name AS label FROM status_changes UNION ALL SELECT 'attitude', change_id, entity_name FROM attitude_changes UNION ALL SELECT 'thread', update_id, title FROM thread_updates""")
def inbox_union(spark, folder):  # S1 S2
    of = lambda name, kind, key, label: table(spark, folder, name).select(F.lit(kind).alias("action_kind"), F.col(key).alias("action_id"), F.col(label).alias("label"))
    return of("status_changes", "status", "change_id", "entity_name").unionByName(of("attitude_changes", "attitude", "change_id", "entity_name")).unionByName(of("thread_updates", "thread", "update_id", "title"))


@query("""SELECT doc_id, substr(sha256(coalesce(source, '') || chr(10) || coalesce(text, '')), 1, 16) AS content_key FROM documents""")
def content_keys(spark, folder):  # I35
    return table(spark, folder, "documents").select("doc_id", F.substring(F.sha2(F.concat_ws("\n", F.coalesce("source", F.lit("")), F.coalesce("text", F.lit(""))), 256), 1, 16).alias("content_key"))


@query("""SELECT coalesce(source, 'all') AS source_name, count(*) AS n_docs, sum(length(text))::BIGINT AS n_letters, grouping(source) AS is_total FROM documents GROUP BY GROUPING SETS ((source), ())""")
def claim_sets(spark, folder):  # grouping sets over documents; E9 not done, E8 is grounding_counts
    d = table(spark, folder, "documents", "source", "text")
    return d.rollup("source").agg(F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("n_letters"), F.grouping("source").cast("long").alias("is_total")).select(F.coalesce("source", F.lit("all")).alias("source_name"), "n_docs", "n_letters", "is_total")


@query("""WITH v AS (SELECT doc_id, count(abusive) AS n, avg(abusive) AS m FROM doc_labels GROUP BY 1)
SELECT doc_id, n AS n_ratings, CASE WHEN n < 2 THEN 'missing' WHEN m IN (0, 1) THEN 'agreed' ELSE 'disputed' END AS verdict FROM v""")
def judge_resolution(spark, folder):  # of E33 agreed, disputed and missing, no adjudication; E34 not done
    v = table(spark, folder, "doc_labels").groupBy("doc_id").agg(F.count("abusive").alias("n_ratings"), F.avg("abusive").alias("m"))
    return v.select("doc_id", "n_ratings", F.when(F.col("n_ratings") < 2, "missing").when(F.col("m").isin(0.0, 1.0), "agreed").otherwise("disputed").alias("verdict"))


@query("""WITH p AS (SELECT session_id, candidate_index, bool_or(same_entity) AS truth, max(ratio) AS ratio FROM adjudications GROUP BY 1, 2 HAVING bool_or(same_entity) IS NOT NULL), t AS (SELECT unnest([0.72, 0.75, 0.85]) AS threshold)
SELECT threshold, count(*) FILTER (ratio >= threshold AND truth) AS tp, count(*) FILTER (ratio >= threshold AND NOT truth) AS fp, count(*) FILTER (ratio < threshold AND truth) AS fn FROM p, t GROUP BY 1""")
def threshold_sweep(spark, folder):  # tp, fp, fn at three thresholds of I7; E25 E26 not done
    p = table(spark, folder, "adjudications").groupBy("session_id", "candidate_index").agg(F.bool_or("same_entity").alias("truth"), F.max("ratio").alias("ratio")).filter("truth is not null")
    long = p.select("truth", "ratio", F.explode(F.array(*[F.lit(x) for x in (0.72, 0.75, 0.85)])).alias("threshold"))
    n = lambda c: F.count(F.when(c, 1))
    hit = F.col("ratio") >= F.col("threshold")
    return long.groupBy("threshold").agg(n(hit & F.col("truth")).alias("tp"), n(hit & ~F.col("truth")).alias("fp"), n(~hit & F.col("truth")).alias("fn"))


@query("""SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS hour_start, count(*) AS n_events FROM events GROUP BY 1, 2""")
def tumbling_counts(spark, folder):  # L18
    return table(spark, folder, "events").groupBy("event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("hour_start")).agg(F.count("*").alias("n_events"))


@query("""WITH m AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM m) SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS n_events FROM i GROUP BY user_id, g""")
def session_windows(spark, folder):  # L18
    e = table(spark, folder, "events", "event_id", "user_id", "ts").withColumn("t", F.col("ts").cast("timestamp"))
    # closed on both sides: a gap of exactly the limit still belongs to the session
    w = F.session_window("t", "30 minutes 0.000001 seconds")
    return e.groupBy("user_id", w).agg(F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count("*").alias("n_events")).drop("session_window")


@query("""SELECT type_name, ng AS ngram, count(*) AS n_found FROM (SELECT coalesce(entity_type, '') AS type_name, unnest([list_extract(w, i) || ' ' || list_extract(w, i + 1) FOR i IN range(1, len(w))]) AS ng FROM (SELECT entity_type, string_split(lower(mention_name), ' ') AS w FROM mentions)) GROUP BY 1, 2""")
def ngram_counts(spark, folder):  # J10 E11
    m = table(spark, folder, "mentions").select(F.coalesce("entity_type", F.lit("")).alias("type_name"), F.split(F.lower("mention_name"), " ").alias("w")).filter(F.size("w") > 1)
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))
    return m.select("type_name", F.explode(grams).alias("ngram")).groupBy("type_name", "ngram").agg(F.count("*").alias("n_found"))


@query("""SELECT n_name AS nation_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def revenue_by_nation(spark, folder):  # engine sanity
    l = table(spark, folder, "lineitem", "l_suppkey", "l_extendedprice", "l_discount").groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    return l.join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("nation_name")).agg(F.round(F.sum("r"), 2).alias("revenue"))
