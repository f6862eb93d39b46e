import random
import re
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from oracle import rows_of, rows_of_sql, views
from sagaloom.llm import abuse, components, mixing, packing, queries, survivors, turns, variants

SF = "/root/testdata/sf0.001"
REGISTRY = "player_id string, canonical string, aliases array<string>, character_name string, character_aliases array<string>"
SEGMENT = "segment_id long, session_id string, seq int, start_s double, end_s double, speaker string, text string"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    columns, want = rows_of_sql(views(SF), entry.oracle_sql()[name])
    assert sorted(df.columns) == columns
    assert rows_of(df) == want


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("P_A", "Brunjo", ["Brunjo (GM)", "SL"], None, []), ("P_B", "Quindel", None, "Haspar Dünnbier", ["Has"])], REGISTRY).cache()


def test_turns(spark, people):
    rows = [
        (1, "s", 0, 1.0, 2.0, None, "vor jedem Namen gesagt"), (2, "s", 1, 2.0, 3.0, "Brunjo (Bote)", "Hallo [Musik]"), (3, "s", 2, 3.0, 2.0, "?", "noch da"),
        (4, "s", 3, 4.0, None, "Quindel", "ähm, (lacht)"), (5, "s", 4, 5.0, 6.0, "BRUNO", "Merke: das zählt. / Haspar: Ja, ja."), (6, "s", 5, 1000.0, 6.0, "", "weiter"),
        (7, "s", 6, 1001.0, 1002.0, "SPEAKER 3", "so"), (9, "s", 6, 2.0, 3.0, "Brunjo (Bote)", " Hallo  [Musik]"), (10, "s", 7, None, 1.0, "SL", "ohne Zeit"), (11, None, 0, 1.0, 1.0, "SL", "ohne Sitzung"),
    ]
    s = spark.createDataFrame([(*r, "clash") for r in rows], SEGMENT + ", label string")
    got = sorted(tuple(r)[1:] for r in turns.turn_bounds(turns.speech(s, people)).collect())
    assert got == [("P_A", 2, 5), ("P_B", 5, 6), ("SPEAKER_03", 7, 7)]
    text = {r.speaker_id: r.turn_text for r in turns.turns(s, people).collect()}
    assert text == {"P_A": "Hallo noch da Merke: das zählt.", "P_B": "Ja. weiter", "SPEAKER_03": "so"}
    assert turns.turn_bounds(turns.speech(s.limit(0), people)).isEmpty()


def test_turns_equal_a_plain_pass(spark):
    """The blocked windows against one ordered pass over the same pieces."""
    import pyspark.sql.functions as F

    from sagaloom.sources.tables import table

    s, r = table(spark, SF, "segments"), table(spark, SF, "player_registry")
    rows = sorted((x.session_id, x.start_s, x.segment_id, x.piece_no, x.known) for x in turns.pieces(s, r).collect())
    want, session, speaker = [], None, None
    for sid, _, seg, _, known in rows:
        if sid != session:
            session, speaker = sid, None
        now = known or speaker
        if now is None:
            continue
        if now == speaker:
            want[-1][3] = seg
        else:
            want.append([sid, now, seg, seg])
        speaker = now
    got = turns.turn_bounds(turns.speech(s, r)).select("session_id", "speaker_id", "first_segment_id", "last_segment_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    assert F is not None


ENTITY = "concept_id string, entity_type string, canonical_name string, aliases array<string>"


def test_variants(spark, people):
    e = spark.createDataFrame([
        ("n/1", "NPC", "Weiwaugon Krakriritaum", ["Der Graue Wolf", "", None]), ("n/2", "Character", "Wutodan Krakriritaum", None), ("n/3", "NPC", "Sazobes Drütigibon", []),
        ("b/1", "Item", "Buch Jitosche von Gidaweimein", None), ("n/4", "NPC", None, None),
    ], ENTITY)
    typed = {
        1: ("Weiwaugon Krakriritaum", "NPC", None), 2: ("krakriritaum, weiwaugon", "NPC", "n/1"), 3: ("Krakriritaum", "NPC", None), 4: ("S. Drütigibon", None, "n/3"),
        5: ("Graf Sazobes Druetigibon", "Character", "n/3"), 6: ("Sazobse Drütigbon", "NPC", "n/3"), 7: ("Jitosche von Gidaweimein", "Item", "b/1"), 8: ("Gidaweimein, Buch Jitosche", "Item", "b/1"),
        9: ("der Wirt", "NPC", None), 10: ("Quinddel", "Player", "P_B"), 11: (None, "NPC", None), 12: ("", None, None), 13: ("WeiwaugonKrakriritaum", "NPC", "n/1"), 14: ("Sazobes Drütigibon", "Item", None),
        15: ("Drütigibon", "NPC", "n/3"),
    }
    m = spark.createDataFrame([(i, n, t) for i, (n, t, _) in typed.items()] + [(99, "Quinddel", "Player")], "mention_id long, mention_name string, entity_type string")
    got = {r.mention_id: r.ref_id for r in variants.resolve(m, e, people).collect()}
    assert got == {i: ref for i, (_, _, ref) in typed.items() if ref} | {99: "P_B"}
    assert variants.resolve(m.limit(0), e, people).isEmpty()


def test_variants_of_frequent_tokens(spark, people):
    """Names of nothing but frequent or short tokens, and one-word names, are found up to the accepted bound."""
    rng = random.Random(6)
    odd = lambda: "".join(rng.choice("bdfghklmprstvwz") + rng.choice("iou") for _ in range(5)).capitalize()
    e = [(f"a/{i}", "NPC", f"Anna {odd()}", []) for i in range(120)] + [(f"m/{i}", "NPC", f"{odd()} Mueller", []) for i in range(120)]
    e += [("x/1", "NPC", "Anna Mueller", []), ("x/2", "NPC", "Bo Mueller", []), ("x/3", "NPC", "Xerquantyl", []), ("x/4", "NPC", "Cyprazentrolavexynth", []), ("x/5", "NPC", "Anna Cyqrexalentovany", [])]
    typed = [("Anna Muelller", "x/1"), ("Nana Mullerr", "x/1"), ("Bo Muelller", "x/2"), ("Xrquantyll", "x/3"), ("Cyrazentolavexyntt", "x/4"), ("Cypra zentrolavxynth", "x/4"), ("Anna Cyrexalntovani", "x/5")]
    m = spark.createDataFrame([(i, n, "NPC") for i, (n, _) in enumerate(typed)], "mention_id long, mention_name string, entity_type string")
    got = {r.mention_id: r.ref_id for r in variants.resolve(m, spark.createDataFrame(e, ENTITY), people).collect()}
    assert got == {i: ref for i, (_, ref) in enumerate(typed)}


def test_variants_of_variants(spark, people):
    """A pet name joins its profile; its own misspelling is too far from every known name and is found only then."""
    e = spark.createDataFrame([("n/1", "NPC", "Weiwaugon Krakriritaum", []), ("n/2", "NPC", "Sazobes Drutigibon", None)], ENTITY)
    typed = [("Weiwa Krakriritaum", 1), ("Weiwa Krakritaum", 2), ("Sazobes Drutigibo", 1)]
    m = spark.createDataFrame([(i, n, "NPC") for i, (n, _) in enumerate(typed)], "mention_id long, mention_name string, entity_type string")
    got = {(r.spelled, r.ref_id, r.round_no) for r in variants.merge_rounds(m, e, people).collect()}
    assert got == {(n, "n/2" if n.startswith("S") else "n/1", r) for n, r in typed}
    assert variants.resolve(m, e, people).count() == 3


@given(st.text("abcdef", min_size=5, max_size=20), st.lists(st.tuples(st.sampled_from("dirs"), st.integers(0, 19), st.sampled_from("abcxyz")), max_size=3))
@settings(max_examples=300, deadline=None)
def test_texts_within_three_edits_meet(a, steps):
    b = a
    for kind, i, x in steps:
        i %= max(len(b), 1)
        b = {"d": b[:i] + b[i + 1 :], "i": b[:i] + x + b[i:], "r": b[:i] + x + b[i + 1 :], "s": b[:i] + b[i + 1 : i + 2] + b[i : i + 1] + b[i + 2 :]}[kind]
    most = variants.swaps_and_edits(a, b, 3)
    if most <= 3:
        assert variants.within_deletions(a, most) & variants.within_deletions(b, most)
        assert variants.halves(a) & variants.beginnings_and_ends(b)


@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
@settings(max_examples=200, deadline=None)
def test_edits_bounds(a, b):
    d = variants.swaps_and_edits(a, b, 9)
    assert d == variants.swaps_and_edits(b, a, 9)
    assert (d == 0) == (a == b)
    assert d <= max(len(a), len(b))


@pytest.mark.parametrize("bound", [30, 2_000_000])
def test_components_equal_brute_force(spark, bound):
    rng = random.Random(5)
    pairs = [("hub", f"h{i}") for i in range(60)] + [(f"c{i}", f"c{i + 1}") for i in range(80)] + [(f"r{rng.randrange(90)}", f"r{rng.randrange(90)}") for _ in range(60)]
    pairs += [("x", "x"), (None, "y"), ("hub", "h1")]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a and b and a != b:
            i, j = sorted((root(a), root(b)))
            parent[j] = i
    got = components.components(spark.createDataFrame(pairs, "a string, b string"), max_edges=bound)
    assert {r.node: r.group_key for r in got.collect()} == {x: root(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a string, b string")).isEmpty()


def test_components_beyond_one_partition(spark):
    """Chains, a hub and random links that never fit one partition, without coalescing: every node reaches its smallest one."""
    rng = random.Random(9)
    names = [f"n{i:04d}" for i in range(300)]
    mixed = rng.sample(names, 300)
    pairs = list(zip(names[:100], names[1:101], strict=True)) + list(zip(mixed[:150], mixed[1:151], strict=True)) + [("hub", f"h{i}") for i in range(80)] + [("n0000", "x0"), ("x0", "x1")]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        i, j = sorted((root(a), root(b)))
        parent[j] = i
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = components.components(spark.createDataFrame(pairs, "a string, b string"), max_edges=30).collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == len(parent)
    assert {r.node: r.group_key for r in rows} == {x: root(x) for x in parent}


def test_forest_is_bounded():
    """A star and a chain in one partition: never more nodes at a time than the bound, and the same components."""
    import pandas as pd

    star = [(f"s{i:05d}", "s") for i in range(5000)]
    chain = [(f"c{i + 1:05d}", f"c{i:05d}") for i in range(5000)]
    frames = list(components.forest([pd.DataFrame(star + chain, columns=["a", "b"])], 100))
    assert max(map(len, frames)) <= 101
    whole = pd.concat(list(components.forest(iter(frames))))
    assert dict(zip(whole.a, whole.b, strict=True)) == {a: "s" for a, _ in star} | {a: "c00000" for a, _ in chain}


def test_latest_values(spark):
    """A learned transition names the current value where a time is missing, against quality."""
    t = lambda d: datetime(2024, 1, d)
    record = "concept_id string, title string, subtype string, description string, home string, resource_url string, quality string, mention_count int, updated_at timestamp_ntz"
    rows = [("a", "Alt", None, None, None, None, "niedrig", 1, t(1)), ("b", "Neu", None, None, None, None, "niedrig", 1, t(2)), ("c", "Alt", None, None, None, None, "hoch", 9, None), ("d", "Neu", None, None, None, None, None, None, None)]
    groups = spark.createDataFrame([(1, ["a", "b"], None), (2, ["c", "d"], None)], "group_id long, concept_ids array<string>, confidence string")
    r = spark.createDataFrame(rows, record)
    assert [tuple(x) for x in survivors.latest_values(groups, r).collect()] == [(2, "title", "d", "Neu", 1)]
    assert {x.concept_id for x in survivors.survivors(groups, r).filter("group_id = 2").collect()} == {"c"}
    assert survivors.latest_values(groups, r.limit(0)).isEmpty()


def test_survivors_with_currency(spark):
    t = lambda d: datetime(2024, 1, d)
    record = "concept_id string, title string, subtype string, description string, home string, resource_url string, quality string, mention_count int, updated_at timestamp_ntz"
    rows = [
        ("a", "Alt", "n/a", "d", None, "", "hoch", 1, t(1)), ("b", "Neu", "X", None, "H", "-", " HOCH ", 1, t(2)), ("c", "Alt", "Y", "e", None, None, "hoch", 9, None), ("d", "Neu", "tbd", None, None, None, "hoch", 1, None), ("e", "q", "q", "q", "q", "q", None, 1, t(9)),
    ]
    groups = [(1, ["a", "b", "b"], None), (7, ["b", "a", "ghost"], "hoch"), (2, ["c", "d"], "mittel"), (3, ["c", "ghost"], "hoch"), (4, [], None), (5, None, None)]
    r, g = spark.createDataFrame(rows, record), spark.createDataFrame(groups, "group_id long, concept_ids array<string>, confidence string")
    got = {(x.group_id, x.field_name): x.concept_id for x in survivors.survivors(g, r).collect()}
    # Alt is followed by Neu in group 7, so without timestamps Neu is the later title of group 2 in spite of fewer mentions
    assert got == {(7, "canonical"): "b", (7, "title"): "b", (7, "subtype"): "b", (7, "description"): "a", (7, "home"): "b", (2, "canonical"): "c", (2, "title"): "d", (2, "subtype"): "c", (2, "description"): "c"}


def test_currency_follows_long_orders(spark):
    """Of 16 values in one learned chain the last is the latest, though an earlier one beyond 12 steps is mentioned more."""
    record = "concept_id string, title string, subtype string, description string, home string, resource_url string, quality string, mention_count int, updated_at timestamp_ntz"
    row = lambda c, i, n, t: (c, f"v{i:02}", None, None, None, None, "hoch", n, t)
    rows = [row(f"{side}{i:02}", i + side, 1, datetime(2024, 1, 1 + side)) for i in range(15) for side in (0, 1)]
    rows += [row(f"m{i:02}", i, 9 if i == 12 else 1, None) for i in range(16)]
    groups = [(i, [f"0{i:02}", f"1{i:02}"], None) for i in range(15)] + [(99, [f"m{i:02}" for i in range(16)], None)]
    r, g = spark.createDataFrame(rows, record), spark.createDataFrame(groups, "group_id long, concept_ids array<string>, confidence string")
    assert [tuple(x) for x in survivors.latest_values(g, r).collect()] == [(99, "title", "m15", "v15", 15)]
    got = {x.field_name: x.concept_id for x in survivors.survivors(g, r).filter("group_id = 99").collect()}
    assert got == {"canonical": "m12", "title": "m15"}


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 20)).filter(lambda s: s[0] != s[1]), max_size=40, unique=True))
@settings(max_examples=300, deadline=None)
def test_lateness_keeps_every_precedence(pairs):
    """Each value is later than all before it, values on one cycle are equal, and up to 12 steps the walk of the SQL agrees."""
    steps = [(f"v{a}", f"v{b}") for a, b in pairs]
    depth = survivors.lateness(steps)
    reach = {(a, b) for a, b in steps}
    for k in depth:
        reach |= {(a, b) for a in depth for b in depth if (a, k) in reach and (k, b) in reach}
    assert all(depth[a] < depth[b] or (depth[a] == depth[b] and (b, a) in reach) for a, b in reach)
    ends = {a for a, _ in steps}
    walk = dict.fromkeys(ends, 0)
    for n in range(1, 13):
        ends = {b for a, b in steps if a in ends}
        walk |= dict.fromkeys(ends, n)
    assert walk == {v: min(d, 12) for v, d in depth.items()}


def test_lateness_of_a_very_long_order():
    n = 20000
    depth = survivors.lateness([(f"v{i}", f"v{i + 1}") for i in reversed(range(n))])
    assert depth == {f"v{i}": i for i in range(n + 1)}
    ring = survivors.lateness([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("x", "e")])
    assert ring == {"a": 12, "b": 12, "c": 12, "d": 13, "e": 14, "x": 0}


@given(st.lists(st.integers(0, 64), max_size=120))
@settings(max_examples=60, deadline=None)
def test_packing_is_whole(sizes):
    n = np.array(sizes, np.int64)
    container, offset = packing.pack(n, 64)
    for c in set(container[n > 0]):
        mine = sorted((o, s) for o, s in zip(offset[(container == c) & (n > 0)], n[(container == c) & (n > 0)], strict=True))
        at = 0
        for o, s in mine:
            assert o == at
            at += s
        assert at <= 64


def test_containers(spark):
    docs = spark.createDataFrame([(1, "wort " * 5000), (2, ""), (3, None), (4, "kurz"), (5, "kurz")], "doc_id long, text string")
    rows = packing.containers(docs, capacity=100).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.n_tokens)
    assert set(by) == {1, 2, 3, 4, 5} and by[2] == by[3] == [0] and len(by[4]) == 1
    assert len(by[1]) == -(-sum(by[1]) // 100)
    assert packing.containers(docs.limit(0)).isEmpty()


def test_cube_keeps_totals():
    rng = np.random.default_rng(0)
    x = rng.integers(1, 400, 500).astype(float).tolist()
    p = [0.3] * 500
    flown = mixing.flight(p, x, rng)
    assert sum(0 < q < 1 for q in flown) <= 2
    assert abs(sum(flown) - 150) < 1e-6 and abs(np.dot(flown, x) - 0.3 * sum(x)) < 1e-4


def test_mixture_meets_shares(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, "big" if i % 3 else "small", "wort " * rng.randrange(5, 60)) for i in range(400)] + [(900, "small", None), (901, "other", "x"), (902, None, "x")], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("none", None, 2)], "source_name string, target_share double, max_repeats int")
    mixed = mixing.mixture(docs, targets)
    report = {r.source: r for r in mixing.mix_report(mixed, targets).collect()}
    assert abs(report["big"].reached_share - 0.5) < 0.01 and report["big"].most_copies <= 1 and report["small"].most_copies <= 3


def test_abuse_tokens_and_segments():
    assert abuse.words("N u t t e du! F.ze Verp!55 dich, Paaaack M*st **Turm** S12 z.B. 12") == ["nutte", "du", "f.ze", "verpiss", "dich", "pack", "m*st", "turm", "s12".translate(abuse.LEET), "z", "b", "0"]
    assert abuse.mask_pattern("sch**ß*").fullmatch("scheiße") and not abuse.mask_pattern("m*st").fullmatch("miist")

    rng = random.Random(1)
    for _ in range(200):
        s = [rng.choice((-2, -1, 1, 2, 3)) for _ in range(rng.randrange(1, 25))]
        best = max((sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=0)
        found = abuse.maximal_segments([float(v) for v in s])
        assert max((f[0] for f in found), default=0) == max(best, 0)
        assert all(a[2] <= b[1] for a, b in zip(found, found[1:], strict=False))


def test_abuse_on_held_out(spark):
    """Planted passages of few words in plain text, labelled by raters who err; held-out recall and precision."""
    rng = random.Random(4)
    plain = [f"der händler {v} den {n} am {z}" for v in ("sucht", "trägt", "prüft", "kauft") for n in ("ring", "turm", "krug", "brief") for z in ("morgen", "abend", "tor")]
    bad = ["du bist ein elender wichser und alle hassen dich", "verpiss dich du dreckiger mistkerl", "man sollte dieses gesindel alle ersäufen", "lutsch ihn du kleine nutte"]
    docs, labels = [], []
    for i in range(900):
        lines = [rng.choice(plain) for _ in range(4)]
        if toxic := i % 6 == 0:
            lines.insert(rng.randrange(5), rng.choice(bad))
        docs.append((i, "a" if i % 2 else None, ". ".join(lines) + "."))
        if i < 600:
            labels.append((i, int(toxic) if rng.random() > 0.05 else 1 - int(toxic)))
    docs += [(1000, "a", None), (1001, "a", "")]
    d = spark.createDataFrame(docs, "doc_id long, source string, text string")
    scores = abuse.scored(d, spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, abusive int"))
    found = {r.doc_id for r in scores.filter("abusive").collect()}
    want = {i for i in range(600, 900) if i % 6 == 0}
    assert len(found & want) >= 0.95 * len(want)
    assert sum(1 for i in found if i >= 600 and i not in want) <= 1
    assert scores.count() == len(docs) and abuse.source_rates(scores).count() == 2
    whole = {r.doc_id: r for r in scores.collect()}
    assert all((r.n_words, r.best_score, r.passage, r.passages, r.abusive) == (0, 0.0, "", [], False) for r in (whole[1000], whole[1001]))
    assert all(r.passages[0].words == r.passage and r.n_passages == len(r.passages) for r in whole.values() if r.abusive)


def test_no_import_from_core():
    import pathlib

    root = pathlib.Path(entry.__file__).parent / "sagaloom"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import)\s+sagaloom\.llm", f.read_text(), re.M)
