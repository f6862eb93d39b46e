from datetime import datetime

import pytest

import __spark_entry__ as entry
from oracle import rows_of, rows_of_sql, views
from sagaloom.functions.names import clock, media_seconds, slug, without_gloss
from sagaloom.operators import concepts, drift, graphs, history, linking, orphans, temporal
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
T = lambda d, h=0: datetime(2024, 1, d, h)


def core_names():
    from sagaloom import queries
    from sagaloom.plans import concepts, reference

    return sorted(queries.ORACLE | reference.ORACLE | concepts.ORACLE)


@pytest.mark.parametrize("name", core_names())
def test_query_equals_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    columns, want = rows_of_sql(views(SF), entry.oracle_sql()[name])
    assert sorted(df.columns) == columns
    assert rows_of(df) == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_name_functions(spark):
    row = spark.createDataFrame([("01:02:03", "12:07", "x", "Über-Größe  A", "held (der alte)")], "a string, b string, c string, d string, e string").select(
        media_seconds(F.col("a")).alias("a"), media_seconds(F.col("b")).alias("b"), media_seconds(F.col("c")).alias("c"), slug(F.col("d")).alias("d"),
        without_gloss(F.col("e")).alias("e"), clock(F.lit(3723.9)).alias("f"),
    ).first()
    assert tuple(row) == (3723, 727, None, "ueber_groesse_a", "held", "01:02:03")


REFS = "id long, a string, b string, at timestamp_ntz"
GOALS = "a string, b string, s timestamp_ntz, e timestamp_ntz"


@pytest.mark.parametrize(("match", "want"), [("partial", {2: "missing", 4: "missing", 6: "late", 7: "deleted"}), ("simple", {2: "missing", 6: "late", 7: "deleted"}), ("full", {2: "missing", 3: "missing", 4: "missing", 6: "late", 7: "deleted"})])
def test_orphans_by_null_mask(spark, match, want):
    refs = spark.createDataFrame([(1, "x", "y", T(5)), (1, "x", "y", T(5)), (2, "x", "q", T(5)), (3, "x", None, T(5)), (4, None, "q", T(5)), (5, None, None, T(5)), (6, "x", "y", T(1)), (7, "x", "y", T(20)), (8, "x", "y", None)], REFS)
    goals = spark.createDataFrame([("x", "y", T(2), T(10)), ("x", "y", T(2), T(10)), ("x", "z", None, None)], GOALS)
    found = orphans.find_orphans(refs, goals, ("a", "b"), ("id",), match, "at", "s", "e")
    assert {r.id: r.orphan_kind for r in found.collect()} == want
    assert orphans.find_orphans(refs.limit(0), goals, ("a", "b"), ("id",), match, "at", "s", "e").isEmpty()
    empty = orphans.find_orphans(refs.filter("id = 1"), goals.limit(0), ("a", "b"), ("id",), match, "at", "s", "e")
    assert [r.orphan_kind for r in empty.collect()] == ["missing"]


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_versions_across_partition_borders(spark, partitions):
    """A hot key is spread over partitions; the stitched history equals a plain fold."""
    import random

    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", f"s{rng.randrange(60):03d}", rng.choice("aab"), i) for i in range(500)]
    got = history.versions(spark.createDataFrame(rows, "k string, s string, v string, i int"), ["k"], "v", "s", [F.col("i")], partitions)
    last = {}
    for k, s, v, i in rows:
        last[k, s] = max(last.get((k, s), (-1, "")), (i, v))
    want = []
    for (k, s), (_, v) in sorted(last.items()):
        if want and want[-1][0] == k and want[-1][1] == v:
            continue
        if want and want[-1][0] == k:
            want[-1][3] = s
        want.append([k, v, s, ""])
    assert sorted(map(tuple, got.select("k", "v", "from_session", "to_session").collect())) == sorted(map(tuple, want))


def test_versions_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, s string, v string, i int")
    assert history.versions(empty, ["k"], "v", "s", [F.col("i")]).isEmpty()


LINES = "line_id long, series string, file_no int, file_name string, line_no int, line_text string"


def test_field_changes(spark):
    files = {
        1: ["Szene;Wurf;DC;Weg", *[f"S1-{i};Klettern mit Hoffnung;{i};alt {i}" for i in range(1, 9)]],
        2: ['﻿"Wurf",Szene,Schwierigkeit (DC),Zeit', *[f'"Klettern, gegen Gift",S2-{i},{i},00:0{i}:00' for i in range(1, 9)], "3"],
        3: ["Wurf,Szene,Schwierigkeit (DC),Zeit", *[f"Klettern,{i},{i}.5,00:0{i}:00" for i in range(1, 9)], "Klettern,n/a,,"],
    }
    rows = [(100 * n + i, "A", n, f"f{n}", i + 1, t) for n, lines in files.items() for i, t in enumerate(lines)]
    rows += [(999, "A", 3, "f3", 3, None), (1000, "B", 1, "g1", 1, "x,y"), (1001, "A", 4, "f4", 2, "no header")]
    lines = spark.createDataFrame(rows, LINES)
    changes = drift.field_changes(lines)
    assert {tuple(r)[2:] for r in changes.collect()} == {
        ("f2", "renamed", "DC", "Schwierigkeit (DC)"), ("f2", "removed", "Weg", ""), ("f2", "added", "", "Zeit"),
        ("f3", "retyped", "Szene", "Szene"), ("f3", "retyped", "Schwierigkeit (DC)", "Schwierigkeit (DC)"),
    }
    unified = drift.unified_table(lines, changes)
    assert unified.filter("file_no = 1 and unified_field = 'Schwierigkeit (DC)'").count() == 8
    assert drift.field_changes(lines.limit(0)).isEmpty()


def test_profiles_of_whole_cells(spark):
    """Columns that differ only after their 12th word, or in shape only after 24 signs, have different profiles."""
    head = "der held geht heute langsam durch den wald und sucht seinen hund "
    row = f"{head}am Abend;{head}im Keller;{'A-0-a-' * 5}7;{'A-0-a-' * 5}b"
    rows = [(i, "A", 1, "f1", i, t) for i, t in enumerate(["a;b;c;d", row, row], 1)]
    lines = spark.createDataFrame(rows, LINES)
    found = {r.field: sorted(r.buckets) for r in drift.profiles(lines, drift.headers(lines)).collect()}
    assert found["a"] != found["b"] and found["c"] != found["d"]


def test_kinds_are_kept_over_blank_files(spark):
    """Whole, then blank, then text is retyped; also if renamed on the way. Whole, blank, whole is not."""
    files = {1: ["a;b;c", *[f"{i};{i};x{i} y" for i in range(1, 9)]], 2: ["a;b;c", *[f";;x{i} y" for i in range(1, 9)]], 3: ["A neu;b;c", *["wort hier;7;x y"] * 8]}
    rows = [(100 * n + i, "A", n, f"f{n}", i + 1, t) for n, lines in files.items() for i, t in enumerate(lines)]
    changes = drift.field_changes(spark.createDataFrame(rows, LINES), lambda x, y: 0.5 if (x.name, y.name) == ("a", "A neu") else 2.0)
    assert {tuple(r)[1:] for r in changes.collect()} == {(3, "f3", "renamed", "a", "A neu"), (3, "f3", "retyped", "a", "A neu")}


def test_tree_edit_of_nested_schemas():
    leaf = lambda n, k="text": drift.Node(n, k)
    a = drift.Node("", children=[drift.Node("person", children=[leaf("name"), leaf("age", "whole")]), leaf("x")])
    b = drift.Node("", children=[leaf("x"), drift.Node("human", children=[leaf("name"), leaf("age", "text"), leaf("home")])])
    cost = lambda p, q: 0.5 if {p.name, q.name} == {"person", "human"} else 2.0
    total, steps = drift.edit_script(a, b, cost)
    assert total == 1.5
    assert set(steps) == {("renamed", "person", "human"), ("retyped", "person.age", "human.age"), ("added", "", "human.home")}


def test_moves_between_parents():
    leaf = lambda n, k="text": drift.Node(n, k)
    a = drift.Node("", children=[drift.Node("person", children=[leaf("name"), leaf("town")]), drift.Node("place", children=[leaf("size")])])
    b = drift.Node("", children=[drift.Node("person", children=[leaf("name")]), drift.Node("place", children=[leaf("size"), leaf("town"), leaf("new")])])
    cost = lambda p, q: 2.0
    steps = drift.with_moves(a, b, drift.edit_script(a, b, cost)[1], cost)
    assert sorted(steps) == [("added", "", "place.new"), ("moved", "person.town", "place.town")]
    flat = drift.Node("", children=[leaf("x")]), drift.Node("", children=[leaf("y")])
    assert sorted(drift.with_moves(*flat, drift.edit_script(*flat, cost)[1], cost)) == [("added", "", "y"), ("removed", "x", "")]


def test_assignment_is_minimal():
    from itertools import permutations

    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 6):
        c = rng.random((n, n))
        assert abs(sum(c[i, j] for i, j in drift.assign(c)) - min(sum(c[i, p[i]] for i in range(n)) for p in permutations(range(n)))) < 1e-9


def test_interval_join_equals_brute_force(spark):
    pts = spark.createDataFrame([("a", float(i)) for i in range(0, 100, 3)], "k string, at double")
    spans = spark.createDataFrame([("a", 10.0, 1), ("a", 97.5, 2), ("b", 10.0, 3)], "k string, center double, id int")
    got = linking.within(pts, spans, ["k"], "at", "center", 7.0)
    assert sorted((r.id, r["at"]) for r in got.collect()) == sorted((i, float(x)) for x in range(0, 100, 3) for c, i in ((10.0, 1), (97.5, 2)) if abs(x - c) <= 7)


def test_grounding_counts_every_citation(spark):
    said = spark.createDataFrame([("s", 700.0, "Lindos ruft"), ("s", 720.0, None), ("s", 5000.0, "Der ROTUNAS kommt"), ("t", 0.0, "Quindel")], "session_id string, start_s double, text string")
    rows = [("Lindo Graf", "NPC", "12:07"), ("Lindo Graf", "NPC", "12:07"), ("lindos", "NPC", "00:12:07"), ("Rotunas", "NPC", "12:07"), ("Quindel", "Item", "12:07"), ("Ox", "Item", "12:07"), ("Lindos", None, "bald"), ("Lindos", None, None), (None, "Item", "12:07"), ("Lindos", "NPC", "0:700")]
    m = spark.createDataFrame([("s", *r) for r in rows], "session_id string, mention_name string, entity_type string, citation_ts string")
    got = {r.type_name: tuple(r)[2:] for r in linking.grounding(m, said).collect()}
    assert got == {"NPC": (4, 1, 0, 0, 0.8), "Item": (0, 0, 1, 2, 0.0), "": (0, 0, 0, 2, 0.0), "all": (4, 1, 1, 4, 0.666667)}
    assert linking.grounding(m.limit(0), said).isEmpty()


def test_subset_pairs(spark):
    t = spark.createDataFrame([("n", "1", ["a", "b"]), ("n", "2", ["a", "b", "c"]), ("n", "3", ["b"]), ("m", "4", ["b"]), ("n", "5", ["a", "b"])], "g string, id string, tok array<string>")
    assert sorted((r.small, r.large) for r in linking.strict_subsets(t, "g", "id", "tok").collect()) == [("1", "2"), ("3", "1"), ("3", "2"), ("3", "5"), ("5", "2")]


def test_state_and_intervals(spark):
    e = spark.createDataFrame([(1, 1, "a", True), (1, 2, "a", True), (1, 3, "b", False), (2, 1, None, None)], "k int, t int, v string, ok boolean")
    assert temporal.collapse_runs(e, ["k"], ["t"], ["v"]).count() == 3
    assert {r.k: r.t for r in temporal.current_state(e, ["k"], ["t"], F.col("ok")).collect()} == {1: 2, 2: 1}
    w = spark.createDataFrame([("s", 0.0, 2.0), ("s", 2.0, 3.0), ("s", 5.0, 6.0)], "k string, lo double, hi double")
    assert sorted((r.lo, r.hi) for r in temporal.merged_intervals(w, ["k"], "lo", "hi").collect()) == [(0.0, 3.0), (5.0, 6.0)]
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c")], "start_id string, end_id string")
    assert graphs.mirrored(edges).filter("was_mirrored").count() == 1


def test_documents_round_trip(spark):
    """Front matter and body make up the document again, whatever it is; nulls, empty texts and broken fences are defined."""
    from sagaloom.functions import texts

    whole = ["---\na: 1\n---\nText\n", "---\n---\n", "---\na: 1\nno end", "plain [x](/a/b.md) and [y](https://z/c.md)", "", None, "---\r\na\r\n---\r\nb", "x\n---\ny\n---\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(whole)], "doc_id int, text string").withColumns(
        {"front": texts.front_matter(F.col("text")), "body": texts.body(F.col("text")), "has": texts.has_front_matter(F.col("text"))}
    ).withColumn("again", texts.document(F.when(F.col("has"), F.col("front")), F.col("body"))).orderBy("doc_id").collect()
    assert [r.again for r in rows] == whole
    assert [r.front for r in rows] == ["a: 1\n", "", "", "", "", None, "", ""]
    assert [r.body for r in rows][:2] == ["Text\n", ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(whole)], "doc_id int, text string")
    assert [tuple(r) for r in concepts.link_table(docs, "doc_id", "text").collect()] == [(3, "x", "/a/b.md")]
    assert concepts.link_table(docs.limit(0), "doc_id", "text").isEmpty()


def test_rounded_times_and_slugs(spark):
    from sagaloom.functions import texts

    r = spark.range(1).select(*[texts.rendered_time(F.lit(x)).alias(n) for n, x in (("a", 0.5), ("b", 1.5), ("c", 3599.5), ("d", -1.0))], slug(F.lit("Éñ  ü!")).alias("e"), slug(F.lit("!?")).alias("f")).first()
    assert tuple(r) == ("00:00:00", "00:00:02", "01:00:00", None, "en_ue", "unnamed")


def test_thread_ledger(spark):
    u = [(1, "t", "s1", "open"), (2, "t", "s2", "Resolved"), (3, "t", "s3", None), (4, "t", "s4", "resolved"), (5, "r", "s1", "resolved"), (6, "r", "s2", "open"), (7, "NEU", "s1", "open"), (8, None, "s1", "open"), (9, "q", "s1", " ")]
    rows = spark.createDataFrame(u, "update_id int, thread_id string, session_id string, thread_status string")
    got = {r.thread_id: tuple(r)[1:] for r in concepts.thread_ledger(rows).collect()}
    assert got == {"t": ("s1", "s4", "resolved", "s2", 4), "r": ("s1", "s2", "open", None, 2), "q": ("s1", "s1", "open", None, 1)}
    assert concepts.thread_ledger(rows.limit(0)).isEmpty()


def test_pairs_are_counted_not_written(spark):
    n = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] * 2 + [("b", "x")], "k string, kind string")
    assert {r.check_name: r.n_pairs for r in concepts.pair_counts(n, "k", "kind").collect()} == {"same_kind": 4, "other_kind": 6}
    assert {r.n_pairs for r in concepts.pair_counts(n.limit(0), "k", "kind").collect()} == {0}


def test_guard_and_forbidden_pairs(spark):
    ids = lambda r: spark.createDataFrame([(f"c{i}",) for i in r], "id string")
    assert tuple(concepts.rename_guard(ids(range(20)), ids(range(1, 22)), "id").first()) == (20, 1, 2, True)
    assert tuple(concepts.rename_guard(ids(range(19)), ids([]), "id").first()) == (19, 19, 0, False)
    g = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "c")], "g int, m string")
    bad = spark.createDataFrame([("b", "a"), ("c", None)], "a string, b string")
    assert sorted(map(tuple, concepts.without_forbidden(g, bad, "g", "m").collect())) == [(2, "a"), (2, "c")]


def test_ambiguous_is_not_absent(spark):
    first = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2"), (None, "3")], "k string, v string")
    second = spark.createDataFrame([("b", "9"), ("c", "9"), ("c", "9")], "k string, v string")
    rows = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "n string")
    got = [tuple(r) for r in linking.resolve_names(rows, [("x", first, F.col("n")), ("y", second, F.col("n"))], "ref").orderBy(F.col("n").asc_nulls_last()).select("n", "ref", "step").collect()]
    assert got == [("a", "1", "x"), ("b", None, "ambiguous"), ("c", "9", "y"), ("d", None, "absent"), (None, None, "absent")]
