"""Filling fixed-capacity containers with items (problem 8): sum-of-squares online packing.

Documents are measured in tokens and spread over blocks of bounded size by a hash of their id. In a block every
document goes, in order of doc_id, to the fill level for which the sum of the squared counts of partly filled containers
grows least; the counts sit in an array over the levels. Containers still far from full at the end of a block are
emptied once and their documents placed again, largest first, by the same rule. A block leaves a handful of partly filled
containers among thousands, so blocks need not be merged.

Only (doc_id, tokens) is shuffled, never text. Defined edge results: a document longer than the capacity is divided
into full containers and a rest, no other is divided; null and empty texts have no tokens and lie in the first container
of their block at offset 0; equal texts are separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sagaloom.session import cut

CAPACITY = 2048
ITEMS_PER_BLOCK = 50_000
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the public split pattern of the byte-level BPE rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def encoding(path: str):
    """The tokenizer of a rank file, loaded once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("sagaloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, *columns: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``columns`` and n_tokens of every document's whole text."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(vocabulary)
        for texts in batches:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return documents.select(*columns, count("text").alias("n_tokens"))


def place(sizes: np.ndarray, order: np.ndarray, capacity: int, container: np.ndarray, offset: np.ndarray, first: int) -> tuple[int, np.ndarray]:
    """Online sum-of-squares packing of ``sizes`` in ``order``. Returns the next free container number and the fills."""
    counts = np.zeros(capacity + 1, np.int64)  # partly filled containers at each level
    standing: list[list[int]] = [[] for _ in range(capacity + 1)]
    fills: list[int] = []
    nxt = first
    for i in order:
        s = int(sizes[i])
        # level h -> h + s, h = 0 is a new container; a full container leaves the count
        gain = 2 * counts[s:] + 1
        gain[-1] = 0
        gain[1:] -= 2 * counts[1 : capacity - s + 1] - 1
        usable = counts[: capacity - s + 1] > 0
        usable[0] = True
        levels = np.flatnonzero(usable)
        g = gain[levels]
        h = int(levels[len(g) - 1 - int(np.argmin(g[::-1]))])  # among equals the fullest
        if h:
            c = standing[h].pop()
            counts[h] -= 1
        else:
            c = nxt
            nxt += 1
            fills.append(0)
        container[i], offset[i] = c, h
        fills[c - first] = h + s
        if h + s < capacity:
            counts[h + s] += 1
            standing[h + s].append(c)
    return nxt, np.asarray(fills, np.int64)


def pack(sizes: np.ndarray, capacity: int = CAPACITY, nearly_full: float = 0.98) -> tuple[np.ndarray, np.ndarray]:
    """Container number and offset of every item; sizes between 0 and ``capacity``. Containers are numbered from 0 without gaps."""
    container, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    real = np.flatnonzero(sizes > 0)
    if not len(real):
        return container, offset
    _, fills = place(sizes, real, capacity, container, offset, 0)
    kept = fills >= nearly_full * capacity
    again = real[~kept[container[real]]]
    stay = real[kept[container[real]]]
    renumber = np.cumsum(kept) - 1
    container[stay] = renumber[container[stay]]
    if len(again):
        again = again[np.argsort(-sizes[again], kind="stable")]
        place(sizes, again, capacity, container, offset, int(kept.sum()))
    return container, offset


def containers(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """doc_id, part_no, n_tokens, container_id, token_offset: where every part of every document lies."""
    sized = cut(token_counts(documents.select("doc_id", "text"), "doc_id", vocabulary=vocabulary))
    blocks = max(1, -(-sized.count() // items_per_block))
    keyed = sized.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))

    def one_block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "n_tokens"], kind="stable")
        n = pdf.n_tokens.to_numpy()
        whole, rest = n // capacity, n % capacity
        pieces = whole + ((rest > 0) | (n == 0))
        row = np.repeat(np.arange(len(n)), pieces)
        part = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.where(part < whole[row], capacity, rest[row])
        container, offset = pack(size, capacity)
        return pd.DataFrame({
            "doc_id": pdf.doc_id.to_numpy()[row], "part_no": part.astype("int32"), "n_tokens": size,
            "container_id": container + int(pdf.block.iloc[0]) * 10**10, "token_offset": offset,
        })

    # a number of partitions that is given is not merged by bytes: rows are few bytes here, but much work
    return keyed.repartition(int(blocks), "block").groupBy("block").applyInPandas(one_block, "doc_id long, part_no int, n_tokens long, container_id long, token_offset long")


def fill_report(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens, unused share of the room, documents divided."""
    by = placed.filter("n_tokens > 0").groupBy("container_id").agg(F.sum("n_tokens").alias("fill"))
    divided = placed.filter("n_tokens > 0").groupBy("doc_id").agg(F.count("*").alias("parts")).agg(F.count(F.when(F.col("parts") > 1, 1)).alias("n_divided"))
    total = by.agg(F.count("*").alias("n_containers"), F.coalesce(F.sum("fill"), F.lit(0)).alias("n_tokens"))
    unused = F.when(F.col("n_containers") > 0, F.round(1 - F.col("n_tokens") / (F.col("n_containers") * capacity), 6)).otherwise(0.0)
    return total.join(divided).select("n_containers", "n_tokens", unused.alias("unused_share"), "n_divided")
