"""Column expressions on names and media times that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Latin letters with a mark, and without.
MARKED, PLAIN = "àáâãåçèéêëìíîïñòóôõùúûýÿčďěňřšťůžąćęłńśźż", "aaaaaceeeeiiiinoooouuuyycdenrstuzacelnszz"


def stripped(c: Column) -> Column:
    """Without outer blanks of any kind; null stays null."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def fold(c: Column) -> Column:
    """Key under which names that differ in case and outer blanks are equal."""
    return F.lower(stripped(c))


def without_gloss(c: Column) -> Column:
    """A folded name without one trailing gloss in round or square brackets."""
    return stripped(F.regexp_replace(c, r"(?U)\s*(\([^()]*\)|\[[^\[\]]*\])\s*$", ""))


def filled(c: Column) -> Column:
    """Not null and not blank."""
    return c.isNotNull() & (F.length(stripped(c)) > 0)


def media_seconds(c: Column) -> Column:
    """Seconds of ``HH:MM:SS`` or ``MM:SS``; null for anything else."""
    text = stripped(c)
    parts = F.split(text, ":")
    number = lambda i: F.element_at(parts, i).cast("int")
    tail = number(-2) * 60 + number(-1)
    return F.when(text.rlike(r"^\d{1,3}:[0-5]?\d:[0-5]?\d$"), number(1) * 3600 + tail).when(
        text.rlike(r"^\d{1,3}:[0-5]?\d$"), tail
    )


def cited_seconds(c: Column) -> Column:
    """Seconds of two or three whole numbers between colons, of any size and sign, as the reference reads a citation; null for anything else."""
    number = r"\s*[+-]?\d{1,9}\s*"
    parts = F.split(c, ":")
    of = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("long")
    tail = of(-2) * 60 + of(-1)
    return F.when(c.rlike(rf"(?U)^{number}:{number}$"), tail).when(c.rlike(rf"(?U)^{number}:{number}:{number}$"), of(1) * 3600 + tail)


def long_words(c: Column, least: int = 4) -> Column:
    """The different words (letters, digits, underscores) of at least so many signs, in lower case and sorted."""
    words = F.filter(F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda w: F.length(w) >= least)
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.lower(w))))


def clock(c: Column) -> Column:
    """``HH:MM:SS`` of a number of seconds, fractions cut off; negative and null give null."""
    s = F.floor(c)
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    hours = F.floor(s / 3600)
    return F.when(
        s >= 0,
        F.concat(
            F.when(hours < 100, two(hours)).otherwise(hours.cast("string")), F.lit(":"),
            two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60),
        ),
    )


def transliterated(c: Column) -> Column:
    """German letters written out: ä ae, ö oe, ü ue, ß ss (upper case likewise)."""
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def slug(c: Column) -> Column:
    """ASCII id: transliterated, marks of Latin letters dropped, lower case, every run of other characters one underscore, none outside; 'unnamed' if nothing is left."""
    plain = F.regexp_replace(F.translate(F.lower(transliterated(c)), MARKED, PLAIN), r"[^a-z0-9]+", "_")
    bare = F.regexp_replace(plain, r"^_+|_+$", "")
    return F.when(bare == "", "unnamed").otherwise(bare)
