"""Column expressions on documents, links, labels and media addresses."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n"
FENCE = "---\n"
LINK = r"\[([^\[\]]*)\]\(([^()\s]+\.md)(?:#[^()\s]*)?\)"


def front_matter(text: Column) -> Column:
    """The lines between the two fences at the beginning of a document, '' if it has none; null stays null."""
    at = F.locate("\n" + FENCE, F.concat(F.lit("\n"), F.substring(text, F.lit(len(FENCE) + 1), F.length(text))))
    return F.when(text.startswith(FENCE) & (at > 0), F.substring(text, F.lit(len(FENCE) + 1), at - 1)).when(text.isNotNull(), F.lit(""))


def has_front_matter(text: Column) -> Column:
    return text.startswith(FENCE) & F.substring(text, F.lit(len(FENCE)), F.length(text)).contains("\n" + FENCE)


def body(text: Column) -> Column:
    """What follows the front matter, as it stands; front matter with its fences and the body make up the document again."""
    return F.when(has_front_matter(text), F.substring(text, F.lit(2 * len(FENCE) + 1) + F.length(front_matter(text)), F.length(text))).otherwise(text)


def document(front: Column, rest: Column) -> Column:
    """The document of a front matter (null for none) and a body."""
    return F.when(front.isNull(), rest).otherwise(F.concat(F.lit(FENCE), front, F.lit(FENCE), rest))


def links(text: Column) -> Column:
    """Array of (label, target) of all Markdown links to concept documents in a text; addresses with a scheme are external."""
    labels, targets = (F.regexp_extract_all(text, F.lit(LINK), F.lit(i)) for i in (1, 2))
    both = F.arrays_zip(labels.alias("label"), targets.alias("target"))
    return F.filter(both, lambda x: ~x["target"].contains("://"))


def rendered_time(seconds: Column) -> Column:
    """``HH:MM:SS`` of a number of seconds, rounded half to even; negative and null give null."""
    s = F.bround(seconds, 0).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    hours = F.floor(s / 3600)
    return F.when(s >= 0, F.concat_ws(":", F.when(hours < 100, two(hours)).otherwise(hours.cast("string")), two(F.floor(s / 60) % 60), two(s % 60)))


def video_id(address: Column) -> Column:
    """Id of a video in its address; '' if it has none."""
    return F.regexp_extract(address, r"(?:[?&]v=|youtu\.be/)([A-Za-z0-9_\-]{6,})", 1)


def address_at(address: Column, seconds: Column) -> Column:
    """The address with a point in time appended."""
    return F.concat(address, F.when(address.contains("?"), "&t=").otherwise("?t="), F.floor(seconds).cast("string"), F.lit("s"))


def sanitized_label(c: Column) -> Column:
    """ASCII letters, digits and underscores only; null if nothing is left."""
    return F.nullif(F.regexp_replace(c, "[^A-Za-z0-9_]", ""), F.lit(""))


def confidence(c: Column) -> Column:
    """high, medium or low of a German level; anything else is medium."""
    low = F.lower(F.trim(c))
    return F.when(low == "hoch", "high").when(low == "niedrig", "low").otherwise("medium")


def article_variants(slug: Column) -> Column:
    """A slug without its leading article, or with each of the three articles."""
    bare = F.regexp_replace(slug, "^(der|die|das)_", "")
    return F.when(bare != slug, F.array(bare)).otherwise(F.array(*[F.concat(F.lit(a + "_"), slug) for a in ("der", "die", "das")]))


def minted_uid(c: Column) -> Column:
    """Stable id of a key. A hash takes the place of a random number, so a repeated run gives the same."""
    return F.concat(F.lit("c_"), F.substring(F.sha2(c, 256), 1, 8))


def is_generic(c: Column, terms: list[str]) -> Column:
    """Whether a name is no one's: its last word is a number, or a word of it contains one of ``terms``."""
    words = F.split(F.lower(F.trim(c)), r"\s+")
    among = [F.exists(words, lambda w: w.contains(t)) for t in terms]  # each lambda is called at once, with this t
    return functools.reduce(Column.__or__, among, F.element_at(words, -1).rlike(r"^[0-9]+$"))
