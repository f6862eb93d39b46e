"""Joins that resolve one kind of record to another: ordered cascades, ambiguity as null, intervals by buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sagaloom.functions.names import cited_seconds, long_words


def unique_or_null(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """One row per key: its value if there is exactly one, null if the key is ambiguous."""
    n = F.countDistinct(value)
    return rows.groupBy(*key).agg(F.when(n == 1, F.min(value)).alias(value), n.alias("n_values"))


def cascade(rows: DataFrame, steps: list[tuple[str, DataFrame]], key: Column, out: str, fallback: Column) -> DataFrame:
    """``out`` and ``step`` from the first lookup (name, DataFrame k, v) that knows the key, else the fallback. Keys of a lookup are unique."""
    found, names = [], []
    rows = rows.withColumn("__k", key)
    for i, (name, lookup) in enumerate(steps):
        rows = rows.join(lookup.select(F.col("k").alias("__k"), F.col("v").alias(f"__v{i}")), "__k", "left")
        found.append(F.col(f"__v{i}"))
        names.append(F.when(F.col(f"__v{i}").isNotNull(), name))
    rows = rows.withColumn(out, F.coalesce(*found, fallback)).withColumn("step", F.coalesce(*names, F.lit("default")))
    return rows.drop("__k", *[f"__v{i}" for i in range(len(steps))])


def within(points: DataFrame, spans: DataFrame, key: list[str], at: str, center: str, reach: float) -> DataFrame:
    """Pairs of a key with ``abs(at - center) <= reach``: an equi-join on buckets of the reach, three per span, then the exact test."""
    bucket = lambda c: F.floor(c / reach)
    left = points.withColumn("__b", bucket(F.col(at)))
    right = spans.withColumn("__b", F.explode(F.array(*[bucket(F.col(center)) + d for d in (-1, 0, 1)])))
    return left.join(right, [*key, "__b"]).filter(F.abs(F.col(at) - F.col(center)) <= reach).drop("__b")


def grounding(mentions: DataFrame, segments: DataFrame, reach: float = 120.0) -> DataFrame:
    """session_id, type_name ('all' and each type), near, elsewhere, nowhere, unscorable, near_ratio of the mentions.

    A word of four signs or more of the name is looked for as part of the text within ``reach`` seconds of the citation,
    then in the whole session; a name without such a word, or a citation that is no time, cannot be scored. A part of a
    text that has only word signs lies inside one of its words, so the session's different words stand for its text;
    they are joined on four signs. Every row counts, repeated ones too; a null type is ''.
    """
    key = ["session_id", "tokens", "sec"]
    m = mentions.select("session_id", F.coalesce("entity_type", F.lit("")).alias("type_name"), long_words(F.col("mention_name")).alias("tokens"), cited_seconds(F.col("citation_ts")).cast("double").alias("sec"))
    asked = m.filter("size(tokens) > 0 and sec is not null").select(*key).distinct()
    text = segments.filter("text is not null").select("session_id", "start_s", F.lower("text").alias("said"))
    near = within(text, asked, ["session_id"], "start_s", "sec", reach).filter(F.exists("tokens", lambda t: F.contains("said", t))).select(*key).distinct()
    words = segments.select("session_id", F.explode(long_words(F.col("text"))).alias("word")).distinct()
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length("word") - 3, F.lit(1))), lambda i: F.substring("word", i, F.lit(4)))
    parts = words.select("session_id", "word", F.explode(F.array_distinct(grams)).alias("gram"))
    each = asked.select(*key, F.explode("tokens").alias("tok"))
    wanted = each.select("session_id", "tok", F.substring("tok", 1, 4).alias("gram")).distinct()
    # four signs have few different values, so those of all names go to every task and the other parts are not shuffled
    parts = parts.join(F.broadcast(wanted.select("gram").distinct()), "gram", "left_semi")
    spoken = wanted.join(parts, ["session_id", "gram"]).filter(F.contains("word", F.col("tok"))).select("session_id", "tok").distinct()
    anywhere = each.join(spoken, ["session_id", "tok"], "left_semi").select(*key).distinct()
    found = near.withColumn("__near", F.lit(1)).unionByName(anywhere.withColumn("__near", F.lit(0))).groupBy(*key).agg(F.max("__near").alias("__near"))
    scorable = (F.coalesce(F.size("tokens"), F.lit(0)) > 0) & F.col("sec").isNotNull()
    kind = F.when(~scorable, "unscorable").when(F.col("__near") == 1, "near").when(F.col("__near") == 0, "elsewhere").otherwise("nowhere")
    rows = m.join(found, key, "left").select("session_id", F.explode(F.array("type_name", F.lit("all"))).alias("type_name"), kind.alias("kind"))
    counts = rows.groupBy("session_id", "type_name").agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in ("near", "elsewhere", "nowhere", "unscorable")])
    scored = F.col("near") + F.col("elsewhere") + F.col("nowhere")
    return counts.withColumn("near_ratio", F.when(scored > 0, F.round(F.col("near") / scored, 6)).otherwise(0.0))


def strict_subsets(rows: DataFrame, group: str, identity: str, tokens: str) -> DataFrame:
    """small, large: pairs of a group whose token set is a strict subset, joined on the subset's rarest token."""
    long = rows.select(group, identity, tokens, F.explode(F.array_distinct(tokens)).alias("t"))
    counts = long.groupBy(group, "t").agg(F.count("*").alias("n"))
    rare = long.join(counts, [group, "t"]).groupBy(group, identity).agg(F.min(F.struct("n", "t"))["t"].alias("t"), F.first(tokens).alias("__small"))
    wide = long.select(group, F.col(identity).alias("large"), F.col(tokens).alias("__large"), "t")
    return (
        rare.join(wide, [group, "t"]).filter(F.col(identity) != F.col("large"))
        .filter((F.size(F.array_except("__small", "__large")) == 0) & (F.size(F.array_distinct("__large")) > F.size(F.array_distinct("__small"))))
        .select(group, F.col(identity).alias("small"), "large")
    )


def resolve_names(rows: DataFrame, steps: list[tuple[str, DataFrame, Column]], out: str) -> DataFrame:
    """``rows`` with ``out`` and ``step``: the first lookup that knows a row's key decides.

    A step is (name, DataFrame k and v, key of the rows). A key of several values is ambiguous: it gives null under the
    step 'ambiguous' and later steps are not tried; a key nobody knows, or a null key, gives null under 'absent'.
    """
    found, names = [], []
    for i, (name, lookup, key) in enumerate(steps):
        one = unique_or_null(lookup.filter("k is not null and v is not null"), ["k"], "v").select(F.col("k").alias(f"__k{i}"), F.struct("v").alias(f"__f{i}"))
        rows = rows.withColumn(f"__k{i}", key).join(one, f"__k{i}", "left")
        found.append(F.col(f"__f{i}"))
        names.append(F.when(F.col(f"__f{i}").isNotNull(), F.when(F.col(f"__f{i}.v").isNull(), "ambiguous").otherwise(name)))
    decided = rows.withColumn(out, F.coalesce(*found)["v"]).withColumn("step", F.coalesce(*names, F.lit("absent")))
    return decided.drop(*[f"__{c}{i}" for i in range(len(steps)) for c in "kf"])
