"""Mixing sources to target weights (problem 9): cube-method balanced sampling.

The total is the largest at which every source can meet its share without a document exceeding its repeats (or a given
one). A source then needs m copies of each document on average: the whole part of m for every document, and the
fraction as an inclusion probability. The cube method moves these probabilities through the null space of the balancing
constraints (tokens and documents of the source), three units at a time, until each is 0 or 1: first in blocks of bounded
size, then over the units every block has left (two at most); the landing problem of the last two is solved by trying
the four ways. Large documents are settled first and what their rounding costs is spread over the probabilities of the
others, so a source meets its tokens up to about one ordinary document.

Only (doc_id, source, tokens) is shuffled. Defined edge results: documents without tokens and of sources without a
target are not used; a source without documents or with a null or non-positive share contributes nothing and the others
keep their own shares of the total; null repeats count as 1; equal texts are separate documents.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sagaloom.llm.packing import VOCABULARY, token_counts
from sagaloom.session import cut

UNITS_PER_BLOCK = 20_000
LARGE = 3.0  # times a source's mean tokens from which on a document is settled before the others
EPS = 1e-9


def flight(p: list[float], x: list[float], rng: np.random.Generator) -> list[float]:
    """Moves ``p`` within the cube, keeping sum(p) and sum(p*x), until at most two entries are fractions."""
    p = list(p)
    draws, at = rng.random(3 * len(p) + 3), 0
    fractions = [i for i, q in enumerate(p) if EPS < q < 1 - EPS]
    waiting = iter(fractions)
    active: list[int] = []
    while True:
        while len(active) < 3 and (i := next(waiting, None)) is not None:
            active.append(i)
        if len(active) < 3:
            return p
        a, b, c = active
        v = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if not (v[0] or v[1] or v[2]):
            v = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, w in zip(active, v, strict=True):
            if w > 0:
                up, down = min(up, (1 - p[i]) / w), min(down, p[i] / w)
            elif w < 0:
                up, down = min(up, p[i] / -w), min(down, (1 - p[i]) / -w)
        step = up if draws[at] * (up + down) < down else -down
        at += 1
        for i, w in zip(active, v, strict=True):
            q = p[i] + step * w
            p[i] = 0.0 if q < EPS else 1.0 if q > 1 - EPS else q
        active = [i for i in active if 0.0 < p[i] < 1.0]


def landing(p: list[float], x: list[float]) -> list[float]:
    """Rounds the last fractions (a flight leaves two at most) the way that keeps sum(p*x) best."""
    left = [i for i, q in enumerate(p) if EPS < q < 1 - EPS]
    want = sum(p[i] * x[i] for i in left)
    ways = product((0.0, 1.0), repeat=len(left))
    best = min(ways, key=lambda w: (abs(sum(v * x[i] for i, v in zip(left, w, strict=True)) - want), w))
    p = list(p)
    for i, v in zip(left, best, strict=True):
        p[i] = v
    return p


def plan(sized: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """source, target_share, max_repeats, source_tokens, source_docs, mean_copies: one row per source with a target."""
    wanted = targets.filter("source_name is not null and target_share > 0").groupBy(F.col("source_name").alias("source")).agg(
        F.sum("target_share").alias("target_share"), F.greatest(F.coalesce(F.max("max_repeats"), F.lit(1)), F.lit(0)).alias("max_repeats")
    )
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"), F.count("*").alias("source_docs"))
    rows = wanted.join(have, "source")
    if total_tokens is None:
        limit = rows.agg(F.min(F.col("max_repeats") * F.col("source_tokens") / F.col("target_share")).alias("t"))
        rows = rows.join(limit)  # one row
    else:
        rows = rows.withColumn("t", F.lit(float(total_tokens)))
    mean = F.least(F.col("t") * F.col("target_share") / F.col("source_tokens"), F.col("max_repeats").cast("double"))
    return rows.select("source", "target_share", "max_repeats", "source_tokens", "source_docs", mean.alias("mean_copies"))


def _sample(units: DataFrame, seed: int) -> DataFrame:
    """``units`` with every p settled to 0 or 1: flights in blocks, a flight over what they leave, the landing."""
    schema = "doc_id long, source string, n_tokens long, whole long, p double, block long, large boolean"

    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        rng = np.random.default_rng([seed, sum(pdf.source.iloc[0].encode()) % 2**31, int(pdf.block.iloc[0])])
        pdf = pdf.iloc[rng.permutation(len(pdf))]
        return pdf.assign(p=flight(pdf.p.tolist(), pdf.n_tokens.astype(float).tolist(), rng))

    def land(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        x = pdf.n_tokens.astype(float).tolist()
        rng = np.random.default_rng([seed, sum(pdf.source.iloc[0].encode()) % 2**31])
        return pdf.assign(p=landing(flight(pdf.p.tolist(), x, rng), x))

    flown = cut(units.groupBy("source", "block").applyInPandas(fly, schema))
    is_open = (F.col("p") > 0) & (F.col("p") < 1)  # at most two per block
    return flown.filter(~is_open).unionByName(flown.filter(is_open).groupBy("source").applyInPandas(land, schema))


def mixture(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, seed: int = 42, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source, n_tokens, copies of every document used."""
    listed = targets.select(F.col("source_name").alias("source")).filter("source is not null").distinct()
    mine = documents.select("doc_id", "source", "text").join(listed, "source", "left_semi")
    sized = cut(token_counts(mine, "doc_id", "source", vocabulary=vocabulary).filter("n_tokens > 0"))
    planned = cut(plan(sized, targets, total_tokens))
    whole = F.floor(F.col("mean_copies") + EPS)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_docs") / UNITS_PER_BLOCK))
    units = sized.join(planned, "source").select(
        "doc_id", "source", "n_tokens", whole.alias("whole"), F.greatest(F.col("mean_copies") - whole, F.lit(0.0)).alias("p"),
        F.pmod(F.xxhash64("doc_id", F.lit(seed)), blocks).alias("block"),
        (F.col("n_tokens") > LARGE * F.col("source_tokens") / F.col("source_docs")).alias("large"),
    )
    # large documents are settled first; what their rounding costs in tokens is spread over the others
    large = cut(_sample(units.filter("large"), seed).join(units.select("doc_id", F.col("p").alias("planned")), "doc_id"))
    owed = large.groupBy("source").agg(F.sum((F.col("planned") - F.col("p")) * F.col("n_tokens")).alias("owed"))
    rest = units.filter("not large")
    room = rest.filter("p > 0").groupBy("source").agg(F.sum("n_tokens").alias("room"))
    shifts = owed.join(room, "source").select("source", (F.col("owed") / F.col("room")).alias("shift"))
    shifted = rest.join(shifts, "source", "left").withColumn(
        "p", F.when(F.col("p") > 0, F.least(F.greatest(F.col("p") + F.coalesce("shift", F.lit(0.0)), F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    )
    done = large.drop("planned").unionByName(_sample(shifted.drop("shift"), seed))
    copies = (F.col("whole") + F.round("p").cast("long")).alias("copies")
    return done.select("doc_id", "source", "n_tokens", copies).filter("copies > 0")


def mix_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, reached_share, tokens_used, docs_used, most_copies of every source with a target."""
    wanted = targets.filter("source_name is not null").groupBy(F.col("source_name").alias("source")).agg(F.sum("target_share").alias("target_share"))
    used = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_used"), F.count("*").alias("docs_used"), F.max("copies").alias("most_copies"))
    total = used.agg(F.sum("tokens_used").alias("total"))
    rows = wanted.join(used, "source", "left").join(total)  # one row
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rows.select(
        "source", "target_share", F.round(F.coalesce(F.col("tokens_used") / F.col("total"), F.lit(0.0)), 6).alias("reached_share"),
        zero("tokens_used"), zero("docs_used"), zero("most_copies"),
    )
