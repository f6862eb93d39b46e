"""Schemas that drift between files (problem 3).

Every file of a series has a schema tree: a root whose children are its fields; fields may have children of their own
(nested records). Consecutive schemas are compared by tree edit distance: at each pair of matched nodes the children
are assigned to each other at minimum cost, which yields the cheapest script of additions, deletions, renames and type
changes; another order costs nothing because it carries no meaning. What is removed under one parent and added under
another with the same name or contents is moved. Renaming is priced by how unlike the contents are, so a
field under another header with the same contents is cheaper to rename than to delete and add. The scripts are
compiled into one projection per file that maps its headers to the consistent fields of the series.

Contents are profiled in one distributed pass: every cell adds to hashed features of its column, so a profile has a
fixed size however large the file is, and aggregation is map-side. A column's header also has a profile over all files
of all series; it recognises a header whose contents change in kind at the moment it is renamed. Only column profiles
(not cells) of one file pair meet in one task.

Defined edge results: a file without a header line is skipped (its neighbours are compared with each other); blank
headers are dropped; a header repeated in one file counts once; lines with another number of cells than the header
count for no profile and are padded or cut in the table; blanks and stand-ins have no kind, and a column without
values keeps the kind it had; empty tables give empty results.
"""

from __future__ import annotations

import csv
import functools
import itertools
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sagaloom.functions.names import fold, stripped
from sagaloom.session import cut, shuffle_partitions

DELIMITERS = (",", ";", "\t", "|")
BUCKETS = 256
#: What people write for nothing, and for yes and no.
STAND_INS = ("n/a", "na", "k. a.", "k.a.", "-", "--", "?", "??", "???", "unbekannt", "unknown", "none", "null", "tbd", "todo", "nan")
KINDS = ("whole", "decimal", "clock", "yesno", "text")
YES, NO = ("true", "ja", "yes", "wahr", "j", "y"), ("false", "nein", "no", "falsch", "n")
SAME_CONTENT = 0.68  # likeness from which on two fields are taken for one that was renamed


# ---------------------------------------------------------------- lines, headers, cells


@F.pandas_udf(T.ArrayType(T.StringType()))
def quoted_cells(line: pd.Series, delimiter: pd.Series) -> pd.Series:
    """Cells of a delimited line with quotes; an unbalanced quote falls back to a plain split. Null stays null."""

    def one(text: str | None, by: str | None) -> list[str] | None:
        if text is None or by is None:
            return None
        try:
            return next(csv.reader([text.replace("\n", " ").replace("\r", " ").replace("\0", "")], delimiter=by), [])
        except csv.Error:
            return text.split(by)

    return pd.Series([one(t, d) for t, d in zip(line, delimiter, strict=True)], dtype=object)


def split_cells(line: str, delimiter: str) -> Column:
    """Cells of a delimited line; only lines with a quote go to Python, the others are split where they are."""
    text, by = F.col(line), F.col(delimiter)
    plain = F.split(F.translate(text, "\n\r\0", "  "), F.concat(F.lit("\\Q"), by, F.lit("\\E")))
    return F.when(text.contains('"'), quoted_cells(F.when(text.contains('"'), text), by)).otherwise(plain)


def clean_header(c: Column) -> Column:
    """A header without byte-order mark, outer quotes and blanks."""
    bare = F.regexp_replace(c, r"(?U)^[\s\x{FEFF}\"']+|[\s\x{FEFF}\"']+$", "")
    return bare


def headers(lines: DataFrame) -> DataFrame:
    """series, file_no, file_name, delimiter, fields, header_text of every file that has a header line."""
    count = lambda d: F.length("h") - F.length(F.replace("h", F.lit(d), F.lit("")))
    best = F.greatest(*[F.struct(count(d).alias("n"), F.lit(-i).alias("i"), F.lit(d).alias("d")) for i, d in enumerate(DELIMITERS)])
    first = (
        lines.filter((F.col("line_no") == 1) & F.col("line_text").isNotNull() & F.col("file_no").isNotNull())
        .groupBy("series", "file_no", "file_name")
        .agg(F.min_by("line_text", "line_id").alias("header_text"))
        .withColumn("h", F.regexp_replace("header_text", r"^\x{FEFF}", ""))
        .withColumn("delimiter", best["d"])
    )
    cells = F.transform(split_cells("h", "delimiter"), clean_header)
    return first.select("series", "file_no", "file_name", "header_text", "delimiter", cells.alias("fields")).filter(
        F.exists("fields", lambda x: F.length(x) > 0)
    )


def cells(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """One row per data line: series, file_no, file_name, line_no, fields, values. Repeats of the header are no data."""
    data = lines.filter((F.col("line_no") > 1) & (F.length(stripped(F.col("line_text"))) > 0)).select(
        "series", "file_no", "file_name", "line_no", "line_id", "line_text"
    )
    joined = data.join(heads, ["series", "file_no", "file_name"]).filter(F.col("line_text") != F.col("header_text"))
    return joined.select(
        "series", "file_no", "file_name", "line_no", "line_id", "fields",
        F.transform(split_cells("line_text", "delimiter"), stripped).alias("values"),
    )


def value_kind(c: Column) -> Column:
    low = fold(c)
    return (
        F.when((F.length(low) == 0) | low.isNull() | low.isin(*STAND_INS), None)
        .when(low.rlike(r"^[+-]?\d+$"), "whole")
        .when(low.rlike(r"^[+-]?\d+[.,]\d+$"), "decimal")
        .when(low.rlike(r"^\d{1,3}:\d{2}(:\d{2})?$"), "clock")
        .when(low.isin(*YES, *NO), "yesno")
        .otherwise("text")
    )


def features(c: Column, kind: Column) -> Column:
    """Hashed traits of one value: kind, shape, words, magnitude."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\p{Lu}+", "A"), r"\p{Ll}+", "a"), r"\d+", "0")
    words = F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: F.length(w) > 1)
    size = F.abs(F.try_to_number(F.regexp_replace(c, ",", "."), F.lit("S9999999D99"))).cast("double")
    magnitude = F.when(kind.isin("whole", "decimal"), F.concat(F.lit("m:"), F.coalesce(F.floor(F.log2(size + 1)).cast("string"), F.lit("big"))))
    names = F.concat(
        F.array(F.concat(F.lit("k:"), F.when(kind == "decimal", "whole").otherwise(kind)), F.concat(F.lit("s:"), shape), magnitude),
        F.when(kind == "text", F.transform(words, lambda w: F.concat(F.lit("w:"), w))).otherwise(F.array().cast("array<string>")),
    )
    names = F.when(kind == "yesno", F.array(F.lit("k:yesno"), F.concat(F.lit("y:"), fold(c).isin(*YES).cast("string")))).otherwise(names)
    return F.transform(F.filter(names, lambda x: x.isNotNull()), lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))


def profiles(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """series, file_no, file_name, field, kind, buckets, counts: one row per column, sizes independent of the rows."""
    rows = cells(lines, heads).filter(F.size("values") == F.size("fields"))
    key = ["series", "file_no", "file_name", "field"]
    long = rows.select("series", "file_no", "file_name", F.explode(F.arrays_zip("fields", "values")).alias("c")).select(
        "series", "file_no", "file_name", F.col("c.fields").alias("field"), F.col("c.values").alias("v")
    ).filter(F.length("field") > 0)
    typed = long.withColumn("k", value_kind(F.col("v"))).filter(F.col("k").isNotNull())
    # a trait below 0 stands for the kind, so that kinds and contents are counted in one pass
    kind_no = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, -1 - i)]), F.col("k"))
    traits = typed.select(*key, F.explode(F.concat(F.array(kind_no), features(F.col("v"), F.col("k")))).alias("b")).groupBy(*key, "b").agg(F.count("*").alias("n"))
    real = F.col("b") >= 0
    seen = lambda k: F.coalesce(F.sum(F.when(F.col("b") == -1 - KINDS.index(k), F.col("n"))), F.lit(0))
    columns = traits.groupBy(*key).agg(
        F.collect_list(F.when(real, F.col("b"))).alias("buckets"), F.collect_list(F.when(real, F.col("n"))).alias("counts"),  # at most BUCKETS each
        seen("whole").alias("w"), seen("decimal").alias("d"), seen("clock").alias("c"), seen("yesno").alias("y"), F.sum(F.when(~real, F.col("n"))).alias("all"),
    )
    share = 0.7
    kind = (
        F.when(F.col("c") >= share * F.col("all"), "clock").when(F.col("y") >= share * F.col("all"), "yesno")
        .when(F.col("w") + F.col("d") >= share * F.col("all"), F.when(F.col("d") > 0.25 * (F.col("w") + F.col("d")), "decimal").otherwise("whole"))
        .otherwise("text")
    )
    fields = heads.select("series", "file_no", "file_name", F.explode(F.array_distinct("fields")).alias("field")).filter(F.length("field") > 0)
    return fields.join(columns.select(*key, kind.alias("kind"), "buckets", "counts"), key, "left")


# ---------------------------------------------------------------- tree edit distance


@dataclass
class Node:
    """A field of a schema: its name, kind, content profile, and the fields nested in it."""

    name: str
    kind: str | None = None
    vector: np.ndarray | None = None
    overall: np.ndarray | None = None
    children: list["Node"] = field(default_factory=list)

    def size(self) -> int:
        return 1 + sum(c.size() for c in self.children)


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Minimum-cost assignment of the rows of a square matrix (shortest augmenting paths)."""
    n = len(cost)
    u, v, match = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1, int)
    for i in range(1, n + 1):
        match[0] = i
        j0, low, way, used = 0, np.full(n + 1, np.inf), np.zeros(n + 1, int), np.zeros(n + 1, bool)
        while True:
            used[j0] = True
            i0 = match[j0]
            free = np.flatnonzero(~used[1:]) + 1
            reduced = cost[i0 - 1, free - 1] - u[i0] - v[free]
            better = reduced < low[free]
            low[free[better]], way[free[better]] = reduced[better], j0
            j1 = free[int(np.argmin(low[free]))]
            delta = low[j1]
            u[match[used]] += delta
            v[used] -= delta
            low[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    return [(match[j] - 1, j - 1) for j in range(1, n + 1)]


def edit_script(a: Node, b: Node, rename_cost: Callable[[Node, Node], float], path: str = "") -> tuple[float, list[tuple[str, str, str]]]:
    """Cost and steps (kind, old path, new path) of the cheapest edit of ``a``'s children into ``b``'s, order aside.

    Deleting or adding a subtree costs its size; keeping a name is free; renaming costs ``rename_cost`` (2 or more is
    never worth it). Matched fields are edited recursively, so their own children move along with them.
    """
    olds, news = a.children, b.children
    n, m = len(olds), len(news)
    if not n + m:
        return 0.0, []
    # not matched is as matched at the price of deleting one and adding the other, so the matrix need not hold both
    k = max(n, m)
    cost, inner = np.zeros((k, k)), {}
    cost[:n, m:] = np.array([[x.size()] for x in olds]) if n > m else 0.0
    cost[n:, :m] = np.array([[y.size() for y in news]]) if m > n else 0.0
    apart = np.zeros((k, k), bool)
    for i, x in enumerate(olds):
        for j, y in enumerate(news):
            if x.children or y.children:
                inner[i, j] = edit_script(x, y, rename_cost)
            price = (0.0 if x.name == y.name else rename_cost(x, y)) + (inner[i, j][0] if (i, j) in inner else 0.0)
            apart[i, j] = price >= x.size() + y.size()
            cost[i, j] = min(price, x.size() + y.size())
    total, steps = 0.0, []
    for i, j in assign(cost):
        total += cost[i, j]
        if i < n and j < m and not apart[i, j]:
            x, y = olds[i], news[j]
            if x.name != y.name:
                steps.append(("renamed", path + x.name, path + y.name))
            if x.kind and y.kind and x.kind != y.kind:
                steps.append(("retyped", path + x.name, path + y.name))
            if (i, j) in inner:
                steps += [(k, o and f"{path}{x.name}.{o}", w and f"{path}{y.name}.{w}") for k, o, w in inner[i, j][1]]
            continue
        if i < n:
            steps.append(("removed", path + olds[i].name, ""))
        if j < m:
            steps.append(("added", "", path + news[j].name))
    return total, steps


def _at(tree: Node, path: str) -> Node:
    """The node under a dotted path; names may hold dots themselves."""
    for c in tree.children:
        if path == c.name:
            return c
        if path.startswith(c.name + ".") and (found := _at(c, path[len(c.name) + 1 :])) is not None:
            return found
    return None


MOVE = 0.5  # price of a move, beside that of a new name


def with_moves(a: Node, b: Node, steps: list[tuple[str, str, str]], rename_cost: Callable[[Node, Node], float]) -> list[tuple[str, str, str]]:
    """``steps`` with a deletion under one parent and an addition under another as a move, where that is cheaper; the cheapest pairs of them."""
    gone, new = [s for s in steps if s[0] == "removed"], [s for s in steps if s[0] == "added"]
    if not gone or not new or not any("." in p for s in gone + new for p in s[1:]):
        return steps  # all under one parent
    k = max(len(gone), len(new))
    price = np.full((k, k), 2.0)
    for i, (_, old, _) in enumerate(gone):
        for j, (_, _, now) in enumerate(new):
            x, y = _at(a, old), _at(b, now)
            if old.removesuffix(x.name) != now.removesuffix(y.name):
                inner = edit_script(x, y, rename_cost)[0] if x.children or y.children else 0.0
                price[i, j] = min(2.0, (MOVE + (0.0 if x.name == y.name else rename_cost(x, y)) + inner) * 2 / (x.size() + y.size()))
    moved = [(gone[i], new[j]) for i, j in assign(price) if i < len(gone) and j < len(new) and price[i, j] < 2.0]
    dropped = {s for pair in moved for s in pair}
    return [s for s in steps if s not in dropped] + [("moved", g[1], w[2]) for g, w in moved]


def cosine(x: np.ndarray | None, y: np.ndarray | None) -> float:
    if x is None or y is None:
        return 0.0
    return float(x @ y)  # both have length 1


@functools.lru_cache(maxsize=100_000)
def name_likeness(a: str, b: str) -> float:
    """0 to 1: common word parts and common letter pairs of two headers."""
    parts = [[p for p in re.split(r"[^0-9a-zäöüß]+", s.lower()) if p] for s in (a, b)]
    whole = ["".join(p) for p in parts]
    if not whole[0] or not whole[1]:
        return 0.0
    if whole[0] == whole[1]:
        return 1.0
    grams = [{w[i : i + 2] for i in range(len(w) - 1)} or {w} for w in whole]
    dice = 2 * len(grams[0] & grams[1]) / (len(grams[0]) + len(grams[1]))
    contained = 0.8 if set(parts[0]) & set(parts[1]) else 0.0
    return max(dice, contained)


def content_cost(x: Node, y: Node) -> float:
    """Price of a rename: 0 for like contents, 2 (that of a deletion with an addition) at ``SAME_CONTENT``."""
    return 2.0 * (1.0 - likeness(x, y)) / (1.0 - SAME_CONTENT)


def likeness(x: Node, y: Node) -> float:
    """0 to 1. Of one kind: contents in the two files, backed by those under the headers over all files. Of two kinds: the latter."""
    here, there, names = cosine(x.vector, y.vector), cosine(x.overall, y.overall), name_likeness(x.name, y.name)
    same_kind = x.kind == y.kind or {x.kind, y.kind} <= {"whole", "decimal"}
    if same_kind:
        return 0.85 * max(here, 0.5 * here + 0.5 * there) + 0.15 * names
    return 0.75 * there + 0.25 * names


def _vector(buckets, counts) -> np.ndarray | None:
    if buckets is None or not len(buckets):
        return None
    v = np.zeros(BUCKETS)
    v[np.asarray(buckets, int)] = np.asarray(counts, float)
    return np.sqrt(v / v.sum())


def field_changes(lines: DataFrame, cost: Callable[[Node, Node], float] = content_cost) -> DataFrame:
    """series, file_no, file_name, change_kind, old_field, new_field: each file against the one before it in its series."""
    heads = headers(lines)
    cols = cut(profiles(lines, heads))  # read four times from here
    # a header's profile over all files, every file weighing the same
    flat = cols.filter(F.col("buckets").isNotNull()).select("field", F.explode(F.arrays_zip("buckets", "counts")).alias("p"), F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("t"))
    overall = flat.groupBy("field", F.col("p.buckets").alias("b")).agg(F.sum(F.col("p.counts") / F.col("t")).alias("n"))
    overall = overall.groupBy("field").agg(F.collect_list("b").alias("all_buckets"), F.collect_list("n").alias("all_counts"))
    order = heads.groupBy("series", "file_no").agg(F.min("file_name").alias("file_name"))
    w = Window.partitionBy("series").orderBy("file_no")  # one row per file
    pairs = order.select("series", "file_no", "file_name", F.lag("file_no").over(w).alias("old_no"), F.lag("file_name").over(w).alias("old_name")).filter("old_no is not null")
    rich = cols.join(overall, "field", "left").select(
        "series", "file_no", "file_name", "field", "kind", "buckets", F.transform("counts", lambda x: x.cast("double")).alias("counts"), "all_buckets", "all_counts"
    )
    new = pairs.select("series", "file_no", "file_name").join(rich, ["series", "file_no", "file_name"]).withColumn("side", F.lit("new"))
    old = (
        pairs.select("series", F.col("old_no"), "old_name", F.col("file_no").alias("for_no"), F.col("file_name").alias("for_name"))
        .join(rich.withColumnsRenamed({"file_no": "old_no", "file_name": "old_name"}), ["series", "old_no", "old_name"])
        .select("series", F.col("for_no").alias("file_no"), F.col("for_name").alias("file_name"), "field", "kind", "buckets", "counts", "all_buckets", "all_counts", F.lit("old").alias("side"))
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        trees = {"old": Node(""), "new": Node("")}
        columns = (pdf[c].tolist() for c in ("side", "field", "kind", "buckets", "counts", "all_buckets", "all_counts"))
        for side, name, kind, *bags in sorted(zip(*columns, strict=True), key=lambda r: r[:2]):
            trees[side].children.append(Node(name, kind, _vector(*bags[:2]), _vector(*bags[2:])))
        _, steps = edit_script(trees["old"], trees["new"], cost)
        steps = with_moves(trees["old"], trees["new"], steps, cost)
        out = pd.DataFrame(steps, columns=["change_kind", "old_field", "new_field"])
        for c in ("series", "file_no", "file_name"):
            out.insert(0, c, pdf[c].iloc[0])
        return out[["series", "file_no", "file_name", "change_kind", "old_field", "new_field"]]

    # a group is the columns (not the rows) of two files
    changes = new.unionByName(old).groupBy("series", "file_no").applyInPandas(
        compare, "series string, file_no int, file_name string, change_kind string, old_field string, new_field string"
    )
    return with_kept_kinds(changes, cols.join(order, ["series", "file_no", "file_name"]).select("series", "file_no", "file_name", "field", "kind"))


def with_kept_kinds(changes: DataFrame, kinds: DataFrame) -> DataFrame:
    """``changes`` and the 'retyped' rows of fields that had no values in the file before: they are compared with the last kind they had.

    A kind goes on through renames; a field that is removed or added starts anew. Only names and kinds of a series meet in one task.
    """
    rows = changes.withColumn("kind", F.lit(None).cast("string")).unionByName(
        kinds.select("series", "file_no", "file_name", F.lit("").alias("change_kind"), F.lit("").alias("old_field"), F.col("field").alias("new_field"), "kind")
    )

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        out, last, seen = [], {}, {}  # last: kind of each field so far; seen: its kind in the file before
        rows = sorted(pdf[[*names, "kind"]].itertuples(index=False, name=None), key=lambda r: (r[1], r[5]))
        for no, group in itertools.groupby(rows, key=lambda r: r[1]):
            group = list(group)
            steps = [r for r in group if r[3]]
            source = {r[5]: r[4] for r in steps if r[3] == "renamed"}
            fresh = {r[5] for r in steps if r[3] == "added"}
            out += [r[:6] for r in steps]
            kept, now = {}, {}
            for series, _, file_name, change, _, new_field, kind in group:
                if change:
                    continue
                before = None if new_field in fresh else source.get(new_field, new_field)
                own, had = kind if isinstance(kind, str) else None, last.get(before)
                if own and had and own != had and seen.get(before) is None:
                    out.append((series, no, file_name, "retyped", before, new_field))
                kept[new_field], now[new_field] = own or had, own
            last, seen = kept, now
        return pd.DataFrame(out, columns=names)

    names = changes.columns
    # a number of partitions that is given is not merged by bytes
    return rows.repartition(shuffle_partitions(rows.sparkSession), "series").groupBy("series").applyInPandas(walk, changes.schema)


def projections(lines: DataFrame, changes: DataFrame) -> DataFrame:
    """series, file_no, field, unified_field: the scripts compiled into one projection per file.

    The renames of a series form chains over its files; every chain takes the name of its last member. Only headers
    meet in a task, never rows.
    """
    heads = headers(lines)
    fields = heads.select("series", "file_no", F.explode(F.array_distinct("fields")).alias("field")).filter(F.length("field") > 0)
    moves = changes.filter(F.col("change_kind") == "renamed").select("series", "file_no", F.col("new_field").alias("field"), "old_field")
    tagged = fields.join(moves, ["series", "file_no", "field"], "left")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        lineage: list[str] = []  # of each chain its latest name
        current: dict[str, int] = {}
        rows = []
        for no, group in pdf.sort_values(["file_no", "field"]).groupby("file_no", sort=True):
            nxt: dict[str, int] = {}
            for r in group.itertuples():
                source = r.old_field if isinstance(r.old_field, str) else r.field
                k = current.get(source)
                if k is None or (source != r.field and k in nxt.values()):
                    k = len(lineage)
                    lineage.append(r.field)
                lineage[k] = r.field
                nxt[r.field] = k
                rows.append((r.series, no, r.field, k))
            current |= nxt  # a field that pauses for a file keeps its chain
        return pd.DataFrame([(s, n, f, lineage[k]) for s, n, f, k in rows], columns=["series", "file_no", "field", "unified_field"])

    return tagged.groupBy("series").applyInPandas(chain, "series string, file_no int, field string, unified_field string")


def unified_table(lines: DataFrame, changes: DataFrame) -> DataFrame:
    """One consistent table of all files in long form: series, file_no, file_name, line_no, unified_field, cell_value."""
    heads = headers(lines)
    rows = cells(lines, heads).groupBy("series", "file_no", "file_name", "line_no").agg(F.min_by(F.struct("fields", "values"), "line_id").alias("r"))
    long = rows.select("series", "file_no", "file_name", "line_no", F.explode(F.arrays_zip(F.col("r.fields").alias("field"), F.col("r.values").alias("value"))).alias("c")).select(
        "series", "file_no", "file_name", "line_no", F.col("c.field").alias("field"), F.coalesce(F.col("c.value"), F.lit("")).alias("cell_value")
    ).filter(F.length("field") > 0)
    return long.join(projections(lines, changes), ["series", "file_no", "field"]).select(
        "series", "file_no", "file_name", "line_no", "unified_field", "cell_value"
    )

