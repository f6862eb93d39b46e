"""Structured Streaming: table streams, windows with watermarks, and histories closed as changes arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def table_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 100) -> DataFrame:
    """A table of a folder as a stream of its files, with the schema it has now."""
    path = f"{folder}/{name}.parquet"
    now = spark.read.parquet(path)
    reader = spark.readStream.schema(now.schema).option("maxFilesPerTrigger", files_per_batch)
    if any(f.endswith(f"/{name}.parquet") for f in now.inputFiles()):  # a single file: a stream reads folders only
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(path)


def window_counts(rows: DataFrame, at: str, key: str, width: str, late: str) -> DataFrame:
    """window_start, key, n_rows over tumbling windows; rows later than ``late`` behind the newest are left out by the watermark."""
    timed = rows.withColumn("__at", F.col(at).cast("timestamp")).withWatermark("__at", late)
    return timed.groupBy(F.window("__at", width), key).agg(F.count("*").alias("n_rows")).select(F.col("window.start").alias("window_start"), key, "n_rows")


def closed_versions(rows: DataFrame, key: str, value: str, moment: str) -> DataFrame:
    """key, value, from_moment, to_moment of every version that a later, different value closes.

    The state of a key is its one open version. Changes arriving within a batch are ordered by moment; one older than the
    open version is too late to change it and is left out.
    """

    def close(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else (None, None)
        out = []
        for v, m in sorted({(v, m) for b in batches for v, m in zip(b["v"], b["m"], strict=True) if v is not None}, key=lambda x: (x[1], x[0])):
            if held[0] is None:
                held = (v, m)
            elif m >= held[1] and v != held[0]:
                out.append((k[0], held[0], held[1], m))
                held = (v, m)
        if held[0] is not None:
            state.update(held)
        yield pd.DataFrame(out, columns=["k", "v", "from_moment", "to_moment"])

    shaped = rows.select(F.col(key).cast("string").alias("k"), F.col(value).cast("string").alias("v"), F.col(moment).cast("string").alias("m")).dropna()
    closed = shaped.groupBy("k").applyInPandasWithState(
        close, "k string, v string, from_moment string, to_moment string", "v string, m string", "append", GroupStateTimeout.NoTimeout
    )
    return closed.withColumnsRenamed({"k": key, "v": value})
