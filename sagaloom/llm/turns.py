"""Speech transcripts into clean speaker turns (problem 1).

SQL expressions take timestamps, marked noise and hesitations out of the text and split it where a known speaker's
name stands as a label. Speakers are forward-filled and consecutive speech is grouped with gaps-and-islands
identifiers, both by windows. A session is cut into blocks of time, so that a session with a third of all rows is
still many window partitions; one row per block then carries the last speaker and the number of turns across blocks.

Defined edge results: rows without words apart from hesitations and annotations count for nothing; a line delivered
again counts once, under its smallest segment_id; null speakers, blanks, ``?`` and labels that name nobody are no
label; speech before the first known speaker of a session has none and comes out nowhere; rows without a session or a
start have no place in time and count for nothing; equal starts are ordered by segment_id; an end that is null, before
its start or past the next turn's start plus a minute is replaced by an estimate; empty tables give an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sagaloom.functions.names import filled, fold
from sagaloom.llm.spelling import deletions, letters
from sagaloom.session import cut

MAX_BROADCAST = 50_000  # distinct labels up to which they are sent to every executor (about 3 MB)
MAX_NAMES = 5000  # bound on the spellings of the people at the table; more are no registry of speakers
BLOCK_SECONDS = 900  # width of a window block
MILLISECONDS_FROM = 100.0  # mean seconds between segments above which a session's clock counts milliseconds
#: What marks a bracketed remark in round brackets as a sound or gesture, as word beginnings.
SOUNDS = ("lach", "trink", "flüster", "geläch", "gelächter", "klatsch", "seufz", "husten", "hust", "räusper", "musik", "applaus", "rausch", "stöhn", "gähn", "nies", "kicher", "murmel", "pause", "stille", "unverständlich", "würfel", "tür", "laugh", "cough", "sigh", "music", "applause", "inaudible", "whisper", "clap")
HESITATION = r"(?iu)(?<![\p{L}\p{N}])(?:[äöüeu]+h+m*|h+m+|m+h+m*)(?![\p{L}\p{N}])(?:\.\.\.|…|[,.])?"
TIMESTAMP = r"\[\d{1,3}(?::\d{2}){1,2}(?:[.,]\d+)?\]|\(\d{1,3}(?::\d{2}){1,2}\)"
ANNOTATION = (
    r"(?iu)\[[^\[\]]*\]|\{[^{}]*\}|\*[^*\n]+\*|♪[^♪]*♪|♪|<[^<>\n]*>|\({2}[^()]*\){2}|\(\s*(?:" + "|".join(SOUNDS) + r")[^()]*\)"
)


def base(c: Column) -> Column:
    return letters(c, written_out=False)


def known_names(registry: DataFrame) -> DataFrame:
    """name_key, player_id, spelled: every spelling of a player and of the character they play, a character's first name too.

    A key of two people is dropped.
    """
    none = F.array().cast("array<string>")
    forms = F.concat(F.array("canonical", "character_name", F.split("character_name", " ")[0]), F.coalesce("aliases", none), F.coalesce("character_aliases", none))
    rows = registry.select("player_id", F.explode(forms).alias("spelled")).filter(filled(F.col("spelled")))
    keyed = rows.select("player_id", "spelled", base(F.col("spelled")).alias("name_key")).filter(F.length("name_key") > 0)
    unique = keyed.groupBy("name_key").agg(F.min("player_id").alias("player_id"), F.countDistinct("player_id").alias("n"), F.min("spelled").alias("spelled"))
    return unique.filter("n = 1").drop("n")


def speaker_labels(labels: DataFrame, column: str, registry: DataFrame) -> DataFrame:
    """label, speaker_id of the distinct labels that name somebody: exactly, else within one edit or swap of one person's name."""
    raw = labels.select(F.col(column).alias("label")).filter(filled(F.col("label"))).distinct()
    low = fold(F.regexp_replace("label", r"^[\s\[<@>\-]+|[\s\]>:]+$", ""))
    voice = F.regexp_extract(low, r"^speaker[\s_\-]*(\d+)$", 1)
    head = F.regexp_replace(F.regexp_replace(low, r"\s*[(/\[].*$|\s+-\s.*$", ""), r"^(?:spieler(?:in)?|player|gm|sl)\s+", "")
    inner = F.regexp_extract(low, r"\(([^()]*)\)", 1)
    tail = F.regexp_extract(low, r"/\s*(.+)$", 1)
    tried = F.filter(F.array(*[F.struct(F.lit(i).alias("rank"), base(c).alias("name_key")) for i, c in enumerate((low, head, inner, tail))]), lambda s: F.length(s["name_key"]) > 0)
    forms = raw.filter(voice == "").select("label", F.explode(tried).alias("f")).select("label", "f.*").filter("name_key != 'unknown'")
    names = known_names(registry)
    exact = forms.join(names, "name_key").groupBy("label").agg(F.min_by("player_id", "rank").alias("speaker_id"))
    left = forms.join(exact, "label", "left_anti").filter(F.length("name_key") >= 4)
    near = (
        left.select("*", F.explode(deletions(F.col("name_key"))).alias("d"))
        .join(names.select(F.col("name_key").alias("n"), "player_id", F.explode(deletions(F.col("name_key"))).alias("d")), "d")
        .select("label", "rank", "player_id", F.levenshtein("name_key", "n").alias("edits")).filter("edits <= 2").distinct()
    )
    best = near.groupBy("label").agg(F.min(F.struct("rank", "edits", "player_id")).alias("b"), F.countDistinct("player_id").alias("people"))
    near_id = best.filter("people = 1").select("label", F.col("b.player_id").alias("speaker_id"))
    voices = raw.filter(voice != "").select("label", F.concat(F.lit("SPEAKER_"), F.lpad(voice.cast("int").cast("string"), F.greatest(F.lit(2), F.length(voice.cast("int").cast("string"))), F.lit("0"))).alias("speaker_id"))
    return exact.unionByName(near_id).unionByName(voices)


def text_labels(registry: DataFrame) -> tuple[str, dict[str, str]]:
    """Regular expression for a speaker's name set as a label in a text, and the player of every name. The registry is checked to be small."""
    rows = known_names(registry).limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} spellings: not a registry of the people at a table")
    names = sorted({r.spelled.strip() for r in rows}, key=lambda s: (-len(s), s))
    names = "|".join(re.sub(r"\\?\s+", r"\\s+", re.escape(n)) for n in names) or r"(?!)"
    who = rf"(?:{names}|SPEAKER[ _]?\d+)"
    pattern = rf"(?iu)(?:(?<![\p{{L}}\p{{N}}])(?:>>\s*|-\s+|/\s+)?({who})(?:\s*\([^()]*\))?\s*:(?=\s|$)|<\s*({who})\s*>)"
    return pattern, {r.name_key: r.player_id for r in rows}


def has_words(text: Column) -> Column:
    """Whether anything is said apart from hesitations, timestamps and marked noise. Most texts show it at a glance."""
    plain = ~text.rlike(r"[\[({*<♪]") & text.rlike(r"(?iu)[b-dfgi-ln-tv-zß]")
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, TIMESTAMP, " "), ANNOTATION, " "), HESITATION, " ")
    return F.when(plain, True).otherwise(rest.rlike(r"[\p{L}\p{N}]"))


def bare(text: Column) -> Column:
    """What is said in a text, without timestamps, marked noise and hesitations, stutters reduced, blanks single."""
    t = F.regexp_replace(text, TIMESTAMP, " ")
    t = F.regexp_replace(t, ANNOTATION, " ")
    t = F.regexp_replace(t, HESITATION, " ")
    t = F.regexp_replace(t, r"(?iu)(?<![\p{L}\p{N}])([\p{L}]+)(?:[,.:?!]*[-\s]+)\1(?![\p{L}\p{N}])", "$1")
    t = F.regexp_replace(t, r"(?U)\s+([,.!?;:])", "$1")
    return F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", " "), r"^[ /\-,.;…>]+|[ /\->]+$", "")


def pieces(segments: DataFrame, registry: DataFrame, *kept: str) -> DataFrame:
    """session_id, block, start_s, segment_id, piece_no, known: the speech of every segment, split at labels, once per delivery.

    ``known`` is the speaker a piece names itself; ``kept`` may add end_s and said (the cleaned words). Everything that
    reads text happens before the only shuffle, which brings a block of time of one session together.
    """
    pattern, people = text_labels(registry)
    labels = speaker_labels(segments.select("speaker").distinct(), "speaker", registry).withColumnRenamed("label", "speaker")
    labels = cut(labels)
    if labels.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        labels = F.broadcast(labels)  # else a shuffle join, hot labels split by the adaptive skew join
    placed = segments.filter(F.col("session_id").isNotNull() & F.col("start_s").isNotNull() & ~F.isnan("start_s") & F.col("text").rlike(r"\S"))
    mark, sep = "\u0001", "\u0002"
    text = F.translate("text", mark + sep, "  ")
    split = F.when(text.contains(":") | text.contains(">"), F.regexp_replace(text, pattern, f"{mark}$1$2{sep}")).otherwise(text)
    words = F.regexp_replace("text", r"(?U)\s+", "")
    parts = placed.select(
        "session_id", "start_s", "end_s", "segment_id", "speaker", F.xxhash64(words, F.length(words)).alias("h"), F.posexplode(F.split(split, mark)).alias("piece_no", "part")
    )
    own = F.split("part", sep)
    labelled = F.col("piece_no") > 0
    parts = parts.select("*", F.when(labelled, own[0]).alias("label"), F.when(labelled, own[1]).otherwise(F.col("part")).alias("words")).filter(has_words(F.col("words")))
    voice = F.regexp_extract(F.lower("label"), r"^\s*speaker[\s_\-]*(\d+)\s*$", 1)
    pairs = [F.lit(x) for pair in people.items() for x in pair] or [F.lit(""), F.lit("")]
    in_text = F.coalesce(F.element_at(F.create_map(*pairs), base(F.col("label"))), F.when(voice != "", F.concat(F.lit("SPEAKER_"), F.lpad(voice, F.greatest(F.lit(2), F.length(voice)), F.lit("0")))))
    said = bare(F.col("words"))
    named = parts.join(labels, "speaker", "left").select(
        "session_id", F.floor(F.col("start_s") / BLOCK_SECONDS).alias("block"), "start_s", "h", "piece_no", "segment_id",
        F.when(labelled, in_text).otherwise(F.col("speaker_id")).alias("known"), *[{"end_s": F.col("end_s"), "said": said.alias("said")}[k] for k in kept],
    )
    named = named.filter("session_id is not null and block is not null")  # as the later join infers on one side only: lets both sides share the shuffle
    once = named.repartition("session_id", "block").groupBy("session_id", "block", "start_s", "h", "piece_no").agg(F.min(F.struct("segment_id", "known", *kept)).alias("r"))
    return once.select("session_id", "block", "start_s", "piece_no", "r.*")


def speech(segments: DataFrame, registry: DataFrame, *kept: str) -> DataFrame:
    """``pieces`` with speaker_id and turn_no: forward-filled over time, counted up at every change of speaker."""
    named = pieces(segments, registry, *kept)
    order = ["start_s", "segment_id", "piece_no"]
    inside = Window.partitionBy("session_id", "block").orderBy(*order)
    filled_in = named.withColumn("here", F.last("known", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    flagged = filled_in.withColumn("change", (F.col("here").isNotNull() & ~F.lag("here").over(inside).eqNullSafe(F.col("here"))).cast("int"))
    counted = flagged.withColumn("inner_no", F.sum("change").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    # one row per block: its first and last speaker and its number of changes
    first = F.min_by("here", F.when(F.col("here").isNotNull(), F.struct(*order)))
    last = F.max_by("here", F.when(F.col("here").isNotNull(), F.struct(*order)))
    blocks = counted.groupBy("session_id", "block").agg(first.alias("first"), last.alias("last"), F.sum("change").alias("changes"))
    across = Window.partitionBy("session_id").orderBy("block")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.withColumn("before", F.last("last", ignorenulls=True).over(before))
    # a block that opens with the speaker who was speaking continues that turn
    goes_on = (F.col("before").isNotNull() & (F.col("first") == F.col("before"))).cast("int")
    carried = carried.withColumn("goes_on", F.coalesce(goes_on, F.lit(0)))
    carried = carried.withColumn("base", F.coalesce(F.sum(F.col("changes") - F.col("goes_on")).over(before), F.lit(0)) - F.col("goes_on"))
    joined = counted.join(carried.select("session_id", "block", "before", "base", "goes_on"), ["session_id", "block"])
    return joined.select(
        "session_id", *order, *kept, F.coalesce("here", "before").alias("speaker_id"),
        (F.col("base") + F.when(F.col("here").isNull(), F.col("goes_on")).otherwise(F.col("inner_no"))).alias("turn_no"),
    ).filter(F.col("speaker_id").isNotNull())


def turn_bounds(said: DataFrame) -> DataFrame:
    """session_id, speaker_id, first_segment_id, last_segment_id of every turn."""
    place = F.struct("start_s", "segment_id", "piece_no")
    return said.groupBy("session_id", "turn_no", "speaker_id").agg(
        F.min(place)["segment_id"].alias("first_segment_id"), F.max(place)["segment_id"].alias("last_segment_id")
    ).select("session_id", "speaker_id", "first_segment_id", "last_segment_id")


def turns(segments: DataFrame, registry: DataFrame) -> DataFrame:
    """Clean turns: session_id, turn_no, speaker_id, turn_start, turn_end (seconds), n_segments, turn_text.

    A session whose segments lie more than ``MILLISECONDS_FROM`` apart on average counts in milliseconds.
    """
    said = speech(segments, registry, "end_s", "said")
    place = F.struct("start_s", "segment_id", "piece_no")
    line = F.struct("start_s", "segment_id", "piece_no", "said")
    usable = F.when((F.col("end_s") > F.col("start_s")) & ~F.isnan("end_s"), F.col("end_s"))
    whole = said.groupBy("session_id", "turn_no", "speaker_id").agg(
        F.min(place)["start_s"].alias("turn_start"), F.max("start_s").alias("last_start"), F.max(usable).alias("seen_end"),
        F.countDistinct("segment_id").alias("n_segments"),
        # a turn is the speech of one person without a break, not a group of unbounded size
        F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["said"]), " ").alias("turn_text"),
    )
    unit = (
        segments.filter(F.col("start_s").isNotNull() & ~F.isnan("start_s")).groupBy("session_id")
        .agg(((F.max("start_s") - F.min("start_s")) / F.greatest(F.count("*") - 1, F.lit(1))).alias("gap"))
        .select("session_id", F.when(F.col("gap") > MILLISECONDS_FROM, 1000.0).otherwise(1.0).alias("per_second"))
    )
    scaled = whole.join(unit, "session_id").select(
        "session_id", "turn_no", "speaker_id", *[(F.col(c) / F.col("per_second")).alias(c) for c in ("turn_start", "last_start", "seen_end")], "n_segments", "turn_text"
    )
    estimate = F.col("last_start") + 0.4 * F.size(F.split("turn_text", " ")) / F.col("n_segments")
    end = F.when(F.col("seen_end").between(F.col("last_start"), F.col("last_start") + 120), F.col("seen_end")).otherwise(estimate)
    return scaled.select("session_id", "turn_no", "speaker_id", F.round("turn_start", 3).alias("turn_start"), F.round(end, 3).alias("turn_end"), "n_segments", "turn_text")
