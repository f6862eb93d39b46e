"""Candidate pairs of spellings by shared deletions, all in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sagaloom.functions.names import fold


def letters(c: Column, written_out: bool = True) -> Column:
    """Folded key of a name: lower case, other marks than letters and digits removed, single blanks.

    Umlauts become two letters if ``written_out``, else their base letter; ß becomes ss.
    """
    low = fold(c)
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue")):
        low = F.replace(low, F.lit(a), F.lit(b if written_out else b[0]))
    for a, b in (("ß", "ss"),):
        low = F.replace(low, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "), r"^ +| +$", "")


def deletions(c: Column) -> Column:
    """The word itself and every form with one character left out: two words within one edit (or swap) share one."""
    n = F.length(c)
    drop = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, n)))
    return F.array_distinct(F.concat(F.array(c), drop))
