"""Variant spellings of names typed by people (problem 4): merge-and-rematch entity resolution.

A profile is everything known about one entity or player: its spellings, their shortened forms and its initials. Each
round every open spelling looks its profile up: first by keys under which it must be equal to a form that only one
compatible profile has (case, hyphens, transliteration, order, titles, epithets, missing parts, initials), then by
edit distance. A spelling that finds exactly one profile is merged: the profile takes it over with its shortened forms
and initials, the richer profiles re-enter blocking, and the rounds go on until nothing merges. From the second round on
only what is new is looked at: keys and forms of the spellings just merged. What came close in earlier rounds is kept,
so a spelling that fits several profiles equally stays open.

The edit search goes from cheap to dear, on distinct forms and, where it can, on distinct words, and what is settled is
not searched again, because fewer edits always win:

* one edit: whole forms that share a deletion;
* two edits in forms of 9 to 17 letters: every profile form is filed under its rarest word and its place; a typed form
  asks with each of its words, and words within two edits share a form with two deletions. Words are compared as a
  vocabulary, not per name, and a frequent word is only ever filed under if all others of its name are more frequent,
  so no list of names grows with the frequency of a word;
* three edits in forms from 16 letters: of the halves of a form one has one edit at most, wherever blanks are.

Mentions are reduced to distinct spellings before anything is compared; key lookups are aggregated per key before the
join, so a key of many profiles costs one row; nothing is collected.

Defined edge results: null, empty and letterless names mean nobody; a name equal to a known one character by character
needs no link; null types are compatible with every type, Character and NPC are one type; repeated rows each get their
link; profiles without usable names and empty tables link nothing; rounds that do not end raise an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sagaloom.functions.names import filled
from sagaloom.llm.spelling import deletions, letters
from sagaloom.session import cut, shuffle_partitions

MAX_ROUNDS = 30  # a guard: rounds end when nothing merges; more of them are an error, never a silent end
LONG = 16  # letters of a form from which on three edits are accepted
#: Forms of address that precede a name.
TITLES = (
    "graf", "graefin", "gr", "koenig", "koenigin", "bruder", "br", "schwester", "schw", "meister", "meisterin", "mstr", "vogt", "voegtin", "hauptmann", "hptm",
    "herr", "hr", "frau", "fr", "dame", "lord", "lady", "sir", "doktor", "dr", "prinz", "prinzessin", "fuerst", "fuerstin", "baron", "baronin", "magister", "mag",
    "spieler", "spielerin", "player", "gm", "sl", "st", "sankt", "heiliger", "heilige", "alter", "alte", "junker", "ritter", "richter", "richterin",
)
ARTICLES = ("der", "die", "das", "the")
LINKS = ("der", "die", "das", "the", "von", "zu", "am", "an", "im", "in", "bei", "aus", "auf", "of", "at", "near", "from", "und", "and")
PET_ENDINGS = ("chen", "lein", "i", "y", "ie", "o", "e", "a", "el")  # what is hung on the beginning of a first name
SHORTEST_NICK = 3


def kind_class(c: Column) -> Column:
    """Types that only match themselves; Character and NPC are one; null, as '', matches all."""
    return F.when(c.isin("Character", "NPC"), "Person").otherwise(F.coalesce(c, F.lit("")))


def _compatible() -> Column:
    return (F.col("m_cls") == "") | (F.col("cls") == "") | (F.col("m_cls") == F.col("cls"))


def known_spellings(entities: DataFrame, registry: DataFrame) -> DataFrame:
    """ref_id, cls, spelled: canonical names and aliases of entities and players."""
    none = F.array().cast("array<string>")
    names = F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", none))).alias("spelled")
    people = F.explode(F.concat(F.array("canonical"), F.coalesce("aliases", none))).alias("spelled")
    rows = entities.select(F.col("concept_id").alias("ref_id"), kind_class(F.col("entity_type")).alias("cls"), names).unionByName(
        registry.select(F.col("player_id").alias("ref_id"), F.lit("Player").alias("cls"), people)
    )
    return rows.filter(filled(F.col("spelled"))).distinct()


def _tokens(c: Column) -> Column:
    """Words of a name, umlauts and their written-out forms alike as one letter."""
    return F.split(F.regexp_replace(letters(c), "([aou])e", "$1"), " ")


def _linked(t: Column) -> Column:
    """The words without those that only link them (von, zu, am, bei ...), sorted."""
    return F.array_join(F.array_sort(F.filter(t, lambda x: ~x.isin(*LINKS))), " ")


def _nicknames(t: Column) -> Column:
    """Keys of the beginnings of a first name (three letters or more) with the last name."""
    first, last = F.element_at(t, 1), F.element_at(t, -1)
    sizes = F.sequence(F.lit(SHORTEST_NICK), F.greatest(F.length(first), F.lit(SHORTEST_NICK)))
    return F.when((F.size(t) == 2) & (F.length(first) > SHORTEST_NICK), F.transform(sizes, lambda n: F.concat(F.lit("K:"), F.substring(first, F.lit(1), n), F.lit("|"), last))).otherwise(F.array().cast("array<string>"))


def _joined(tokens: Column) -> Column:
    return F.array_join(tokens, "")


def _sorted(tokens: Column) -> Column:
    return F.array_join(F.array_sort(tokens), " ")


def _initials(t: Column) -> Column:
    """Keys of a first initial with the last name, and of a first name with the last initial."""
    n = F.size(t)
    first, last = F.element_at(t, 1), F.element_at(t, -1)
    return F.when(n >= 2, F.array(F.concat(F.lit("I:"), F.substring(first, 1, 1), F.lit("|"), last), F.concat(F.lit("J:"), first, F.lit("|"), F.substring(last, 1, 1)))).otherwise(F.array().cast("array<string>"))


def _tail(t: Column) -> Column:
    """A name of three or more parts without its first (the sort of thing it is)."""
    return F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(1)))


def profile_keys(spelled: DataFrame) -> DataFrame:
    """ref_id, cls, key: the forms of every spelling of a profile."""
    t = F.col("t")
    tag = lambda p, c: F.concat(F.lit(p), c)
    keys = F.concat(
        F.array(tag("N:", _joined(t)), tag("S:", _sorted(t))),
        F.when(F.size(t) >= 2, F.array(tag("C:", _linked(t)))).otherwise(F.array().cast("array<string>")),
        F.when(F.size(t) >= 3, F.array(tag("D:", _sorted(_tail(t))))).otherwise(F.array().cast("array<string>")),
        F.when(F.size(t) >= 2, F.transform(F.filter(t, lambda x: F.length(x) >= 4), lambda x: F.concat(F.lit("T:"), x))).otherwise(F.array().cast("array<string>")),
        _initials(t), _nicknames(t),
    )
    return spelled.withColumn("t", _tokens(F.col("spelled"))).filter(F.col("t")[0] != "").select("ref_id", "cls", F.explode(keys).alias("key")).distinct()


def mention_keys(spelled: DataFrame) -> DataFrame:
    """spelled, cls, rank, key: under which forms a typed name may be known, surest first."""
    t, n = F.col("t"), F.size("t")
    pair = lambda rank, c: F.struct(F.lit(rank).alias("rank"), c.alias("key"))
    tag = lambda p, c: F.concat(F.lit(p), c)
    headless, tailless = F.slice(t, 2, F.greatest(n - 1, F.lit(1))), F.slice(t, 1, F.greatest(n - 2, F.lit(1)))
    middle = F.slice(t, 2, F.greatest(n - 3, F.lit(1)))
    titled, epithet = F.element_at(t, 1).isin(*TITLES), F.element_at(t, -2).isin(*ARTICLES)
    last, first = F.element_at(t, -1), F.element_at(t, 1)
    plain = _tokens(F.regexp_replace("spelled", r"(?U)\s*\([^()]*\)\s*$", ""))
    # a pet name: the beginning of a first name, with or without an ending
    pets = [F.when(F.endswith(first, F.lit(x)) & (F.length(first) >= SHORTEST_NICK + len(x)), F.substring(first, F.lit(1), F.length(first) - len(x))) for x in PET_ENDINGS]
    stems = [F.when(F.length(first) >= SHORTEST_NICK, first), *pets]
    nick = [F.when(n == 2, pair(9 + (i > 0), F.concat(F.lit("K:"), stem, F.lit("|"), last))) for i, stem in enumerate(stems)]
    tried = F.array(
        pair(0, tag("N:", _joined(t))), pair(1, tag("S:", _sorted(t))),
        F.when(F.size(plain) < n, pair(1, tag("N:", _joined(plain)))), F.when(n >= 2, pair(1, tag("C:", _linked(t)))),
        F.when((n >= 2) & titled, pair(2, tag("N:", _joined(headless)))),
        F.when((n >= 3) & titled, pair(2, tag("S:", _sorted(headless)))),
        F.when((n >= 4) & epithet, pair(3, tag("N:", _joined(tailless)))), F.when((n >= 4) & epithet, pair(3, tag("S:", _sorted(tailless)))),
        F.when((n >= 5) & epithet & titled, pair(4, tag("S:", _sorted(middle)))),
        F.when(n >= 3, pair(5, tag("S:", _sorted(headless)))),
        F.when(n >= 2, pair(6, tag("D:", _sorted(t)))), F.when((n >= 3) & titled, pair(6, tag("D:", _sorted(headless)))),
        F.when((n == 2) & (F.length(first) == 1), pair(7, F.concat(F.lit("I:"), first, F.lit("|"), last))),
        F.when((n == 2) & (F.length(last) == 1), pair(7, F.concat(F.lit("J:"), first, F.lit("|"), last))),
        # the initial behind the name, as in a list: "Name, V."
        F.when((n == 2) & (F.length(last) == 1), pair(7, F.concat(F.lit("I:"), last, F.lit("|"), first))),
        F.when(n == 1, pair(8, tag("T:", first))), F.when((n == 2) & titled, pair(8, tag("T:", last))),
        *nick,
    )
    return (
        spelled.withColumn("t", _tokens(F.col("spelled"))).filter(F.col("t")[0] != "")
        .select("spelled", "cls", F.explode(F.filter(tried, lambda s: s["key"].isNotNull())).alias("k")).select("spelled", "cls", "k.*").distinct()
    )


def by_key(open_names: DataFrame, spelled: DataFrame, fresh: DataFrame | None = None) -> DataFrame:
    """spelled, cls, ref_id of the open names with a surest key that one compatible profile has.

    With ``fresh`` spellings only names that share a key with one of them are looked at.
    """
    asked = mention_keys(open_names)
    if fresh is not None:
        touched = asked.join(_sorted_side(profile_keys(fresh).select("key").distinct()), "key", "left_semi").select("spelled", "cls").distinct()
        asked = asked.join(_sorted_side(touched), ["spelled", "cls"], "left_semi")
    # per key and type at most one row: how many profiles, and which
    owners = profile_keys(spelled).groupBy("key", "cls").agg(F.count("*").alias("n"), F.min("ref_id").alias("ref_id"))
    hits = (
        asked.withColumnRenamed("cls", "m_cls").join(_sorted_side(owners), "key")
        .filter(_compatible())
        .groupBy("spelled", "m_cls", "rank").agg(F.sum("n").alias("n"), F.countDistinct("ref_id").alias("d"), F.min("ref_id").alias("ref_id"), F.max("n").alias("most"))
    )
    best = hits.groupBy("spelled", "m_cls").agg(F.min(F.struct("rank", "most", "d", "ref_id")).alias("b"))
    return best.filter("b.most = 1 and b.d = 1").select("spelled", F.col("m_cls").alias("cls"), "b.ref_id")


def swaps_and_edits(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between two strings, or ``most + 1`` if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            now.append(v)
        if min(now) > most:
            return most + 1
        before, row = row, now
    return row[-1]


@F.pandas_udf(T.IntegerType())
def edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([swaps_and_edits(x, y, 3) for x, y in zip(a, b, strict=True)], dtype="int32")


def _forms_of_profiles(spelled: DataFrame) -> DataFrame:
    """ref_id, cls, weight, form, t: the spellings a typed name is compared with, and their tokens."""
    t, n = F.col("t"), F.size("t")
    forms = F.array(
        F.struct(F.lit(0).alias("weight"), t.alias("ft")),
        F.when(n >= 3, F.struct(F.lit(1).alias("weight"), _tail(t).alias("ft"))),
        F.when(n == 2, F.struct(F.lit(1).alias("weight"), F.array(F.substring(F.element_at(t, 1), 1, 1), F.element_at(t, -1)).alias("ft"))),
        F.when((n == 2) & (F.length(F.element_at(t, -1)) >= 8), F.struct(F.lit(2).alias("weight"), F.array(F.element_at(t, -1)).alias("ft"))),
    )
    rows = spelled.withColumn("t", _tokens(F.col("spelled"))).filter(F.col("t")[0] != "")
    return rows.select("ref_id", "cls", F.explode(F.filter(forms, lambda s: s.isNotNull())).alias("f")).select(
        "ref_id", "cls", "f.weight", F.col("f.ft").alias("t"), _joined(F.col("f.ft")).alias("form")
    ).filter(F.length("form") >= 5).distinct()


def _forms_of_mentions(open_names: DataFrame) -> DataFrame:
    """spelled, cls, weight, form, t: the orders and shortenings in which a typed name is compared."""
    t, n = F.col("t"), F.size("t")
    titled, epithet = F.element_at(t, 1).isin(*TITLES), F.element_at(t, -2).isin(*ARTICLES)
    comma = F.split("spelled", ",", 2)
    turned = F.concat(_tokens(F.element_at(comma, 2)), _tokens(F.element_at(comma, 1)))
    forms = F.array(
        F.struct(F.lit(0).alias("weight"), t.alias("ft")),
        F.when(F.size(comma) == 2, F.struct(F.lit(0).alias("weight"), F.filter(turned, lambda x: x != "").alias("ft"))),
        F.when((F.size(comma) == 1) & (n == 2), F.struct(F.lit(1).alias("weight"), F.reverse(t).alias("ft"))),
        F.when((n >= 2) & titled, F.struct(F.lit(0).alias("weight"), F.slice(t, 2, F.greatest(n - 1, F.lit(1))).alias("ft"))),
        F.when((n == 3) & titled, F.struct(F.lit(1).alias("weight"), F.reverse(F.slice(t, 2, 2)).alias("ft"))),
        F.when((n >= 4) & epithet, F.struct(F.lit(0).alias("weight"), F.slice(t, 1, F.greatest(n - 2, F.lit(1))).alias("ft"))),
    )
    rows = open_names.withColumn("t", _tokens(F.col("spelled"))).filter(F.col("t")[0] != "")
    return rows.select("spelled", "cls", F.explode(F.filter(forms, lambda s: s.isNotNull())).alias("f")).select(
        "spelled", "cls", "f.weight", F.col("f.ft").alias("t"), _joined(F.col("f.ft")).alias("form")
    ).filter(F.length("form") >= 5).distinct()


def _bound(length: Column) -> Column:
    """Accepted edits between two forms whose shorter one has this many letters."""
    return F.when(length >= LONG, 3).when(length >= 9, 2).otherwise(1)


def within_deletions(text: str, most: int) -> set[str]:
    """The text and every form with up to ``most`` characters left out: two texts within that many edits (or swaps) share one."""
    found = level = {text}
    for _ in range(most):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        found = found | level
    return found


def halves(text: str) -> set[str]:
    """Both halves, also without the letters at the cut, up to one deletion: of three edits one side has one at most, and a swap over the cut leaves two."""
    h = len(text) // 2
    return set().union(*(within_deletions(x, 1) for x in (text[:h], text[h:], text[: max(h - 1, 0)], text[h + 1 :])))


def beginnings_and_ends(text: str) -> set[str]:
    """What lies within one deletion of any half of a text within three edits of this one."""
    n = len(text)
    sizes = range(max(0, n // 2 - 4), min(n, n // 2 + 3) + 1)
    return set().union(*(within_deletions(x, 1) for i in sizes for x in (text[:i], text[n - i :])))


def _one_swap(a: Column, b: Column) -> Column:
    """Whether two strings of one length become equal by swapping two neighbours."""
    turned = lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a)))
    return (F.length(a) == F.length(b)) & F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), lambda i: turned(i) == b)


def one_edit_pairs(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """m_form, form, e of all forms within one edit or swap: they share a deletion."""
    keyed = lambda df: df.select("form").distinct().select("form", F.explode(F.transform(deletions(F.col("form")), lambda d: F.xxhash64(d))).alias("block"))
    met = keyed(mine).withColumnRenamed("form", "m_form").join(_sorted_side(keyed(theirs)), "block").withColumn("e", F.levenshtein("m_form", "form", 2)).filter("e >= 0")
    e = F.when(F.col("e") <= 1, F.col("e")).when(_one_swap(F.col("m_form"), F.col("form")), 1)
    return met.select("m_form", "form", e.alias("e")).filter("e is not null").distinct()


def _within_two(words: DataFrame, name: str) -> DataFrame:
    """n, place, ``name``, block of distinct words: the word with up to two letters left out."""
    twice = F.array_distinct(F.flatten(F.transform(deletions(F.col("word")), lambda d: deletions(d))))
    rows = words.distinct().select("n", "place", "word", F.explode(F.transform(twice, lambda d: F.xxhash64("n", "place", d))).alias("block"))
    return rows.withColumnRenamed("word", name)


def rarest_words(forms: DataFrame) -> DataFrame:
    """form, n, place, word: every form under its rarest word, the place of that word and the number of words."""
    each = forms.select("form", "t").distinct().select("form", "t", F.posexplode("t").alias("place", "word"))
    counts = each.groupBy("word").agg(F.count("*").alias("seen"))
    best = each.join(_sorted_side(counts), "word").groupBy("form", "t").agg(F.min(F.struct("seen", -F.length("word"), "place", "word")).alias("b"))
    return best.select("form", F.size("t").alias("n"), F.col("b.place").alias("place"), F.col("b.word").alias("word"))


def word_pairs(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """m_form, form of 9 to 17 letters whose words stand in the same places and whose rarest word is within two edits."""
    short = F.length("form").between(9, LONG + 1)
    filed = rarest_words(theirs.filter(short))
    typed = mine.filter(short).select(F.col("form").alias("m_form"), "t").distinct()
    asked = typed.select("m_form", F.size("t").alias("n"), F.posexplode("t").alias("place", "word"))
    # a blank too many: the whole as one word
    asked = asked.unionByName(typed.filter(F.size("t") > 1).select("m_form", F.lit(1).alias("n"), F.lit(0).alias("place"), F.col("m_form").alias("word"))).distinct()
    key = ["n", "place", "word"]
    alike = _within_two(asked.select(*key), "typed_word").join(_sorted_side(_within_two(filed.select(*key), "filed_word").drop("n", "place")), "block").select("n", "place", "typed_word", "filed_word").distinct()
    met = asked.join(_sorted_side(alike.withColumnRenamed("typed_word", "word")), key).select("m_form", "n", "place", F.col("filed_word").alias("word"))
    return met.join(_sorted_side(filed), key).select("m_form", "form")


def _exploded(forms: DataFrame, name: str, parts: Callable[[str], set[str]]) -> DataFrame:
    """``name``, block: the parts of every form, as hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple[str, str]] = []
            for form in pdf["form"]:
                out += [(form, x) for x in parts(form)]
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=[name, "part"])
                    out = []
            yield pd.DataFrame(out, columns=[name, "part"])

    return forms.mapInPandas(run, f"{name} string, part string").select(name, F.xxhash64("part").alias("block"))


def half_pairs(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """m_form, form of 16 letters or more that have a half in common up to one deletion, wherever their blanks are."""
    long = lambda df: df.select("form").filter(F.length("form") >= LONG).distinct()
    return _exploded(long(mine), "m_form", beginnings_and_ends).join(_sorted_side(_exploded(long(theirs), "form", halves)), "block").select("m_form", "form")


def _scores(pairs: DataFrame, mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """spelled, cls, ref_id, s: of every typed name and profile the fewest edits and the lowest weight."""
    left = mine.select("spelled", F.col("cls").alias("m_cls"), F.col("weight").alias("m_weight"), F.col("form").alias("m_form"))
    right = theirs.select("ref_id", "cls", "weight", "form")
    met = pairs.join(_sorted_side(left), "m_form").join(_sorted_side(right), "form").filter(_compatible())
    return met.groupBy("spelled", F.col("m_cls").alias("cls"), "ref_id").agg(F.min(F.struct("e", (F.col("weight") + F.col("m_weight")).alias("w"))).alias("s"))


def by_edits(open_names: DataFrame, fresh: DataFrame) -> DataFrame:
    """spelled, cls, ref_id, s (edits, weight) of the open names and the profiles one of whose ``fresh`` forms is within the accepted edits and nearest."""
    theirs, mine = cut(_spread(_forms_of_profiles(fresh), "form")), cut(_spread(_forms_of_mentions(open_names), "form"))
    near = cut(_scores(one_edit_pairs(mine, theirs), mine, theirs))
    rest = cut(_spread(mine.join(near.select("spelled", "cls").distinct(), ["spelled", "cls"], "left_anti"), "form"))
    bound = _bound(F.least(F.length("m_form"), F.length("form")))
    met = word_pairs(rest, theirs).unionByName(half_pairs(rest, theirs)).filter((F.length("m_form") >= 9) & (F.levenshtein("m_form", "form", 6) >= 0)).distinct()
    far = met.withColumn("e", edits("m_form", "form")).filter(F.col("e") <= bound)
    return near.unionByName(_scores(far, rest, theirs))


def nearest(scores: DataFrame) -> DataFrame:
    """``scores`` of the nearest profiles of every name; several rows of a name are a tie."""
    w = Window.partitionBy("spelled", "cls")  # one name's profiles within the accepted edits
    return scores.withColumn("least", F.min("s").over(w)).filter("s = least").select("spelled", "cls", "ref_id", "s").distinct()


def merge_rounds(mentions: DataFrame, entities: DataFrame, registry: DataFrame) -> DataFrame:
    """spelled, cls, ref_id, round_no of every typed spelling that was merged into a profile, and the round in which it was."""
    profile = cut(_spread(known_spellings(entities, registry), "ref_id"))
    known = profile.select(F.col("spelled").alias("mention_name")).distinct()
    typed = mentions.filter(filled(F.col("mention_name"))).select("mention_name", kind_class(F.col("entity_type")).alias("cls")).distinct()
    open_names = typed.join(known, "mention_name", "left_anti").withColumnRenamed("mention_name", "spelled")
    classes = profile.groupBy("ref_id").agg(F.min("cls").alias("cls"))
    fresh, ties, found = None, None, None
    for round_no in range(1, MAX_ROUNDS + 1):
        open_names = cut(_spread(open_names, "spelled"))
        sure = cut(by_key(open_names, profile, fresh))
        scores = by_edits(_without(open_names, sure), profile if fresh is None else fresh)
        # what came equally close in earlier rounds still counts
        near = cut(nearest(scores if ties is None else scores.unionByName(ties)))
        single = near.groupBy("spelled", "cls").agg(F.count("*").alias("n"), F.min("ref_id").alias("ref_id")).filter("n = 1").drop("n")
        merged = cut(_spread(sure.unionByName(single).withColumn("round_no", F.lit(round_no)), "spelled"))
        if merged.isEmpty():
            return merged if found is None else found
        found = merged if found is None else found.unionByName(merged)
        open_names, ties = _without(open_names, merged), _without(near, merged)
        # the profiles take the merged spellings over; only what is new has to be compared again
        fresh = merged.select("ref_id", "spelled").distinct().join(classes, "ref_id").select("ref_id", "cls", "spelled")
        profile = profile.unionByName(fresh)
    raise RuntimeError(f"spellings still merge after {MAX_ROUNDS} rounds")


def resolve(mentions: DataFrame, entities: DataFrame, registry: DataFrame) -> DataFrame:
    """mention_id, ref_id of the mentions whose name is a variant of one known name."""
    links = merge_rounds(mentions, entities, registry).select(F.col("spelled").alias("mention_name"), "cls", "ref_id")
    rows = mentions.select("mention_id", "mention_name", kind_class(F.col("entity_type")).alias("cls"))
    return rows.join(links, ["mention_name", "cls"]).select("mention_id", "ref_id").distinct()


def _sorted_side(rows: DataFrame) -> DataFrame:
    """``rows`` for a sort-merge join: Spark takes exploded rows for as few as there were before, and would broadcast them."""
    return rows.hint("merge")


def _spread(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` over all tasks: few bytes become many keys here, so adaptive coalescing by bytes would leave one task."""
    return rows.repartition(shuffle_partitions(rows.sparkSession), by)


def _without(names: DataFrame, done: DataFrame) -> DataFrame:
    return names.join(done.select("spelled", "cls"), ["spelled", "cls"], "left_anti")
