"""Files of the domain as tables: transcripts in JSON, delimited roll reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRANSCRIPT = "video_date string, video_url string, video_title string, language string, segments array<struct<start double, end double, speaker string, text string>>"


def _stem(path):
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment of the JSON transcripts under ``path`` (A1). The session is the file's stem; missing times are 0, missing texts ''."""
    raw = spark.read.schema(TRANSCRIPT).json(path, multiLine=True).select(_stem(F.input_file_name()).alias("session_id"), "*")
    rows = raw.select(
        "session_id", F.coalesce("video_date", F.lit("")).alias("session_date"), F.coalesce("video_url", F.lit("")).alias("url"),
        F.coalesce("language", F.lit("de")).alias("lang"), F.posexplode("segments").alias("seq", "s"),
    )
    zero, blank = F.lit(0.0), F.lit("")
    return rows.select(
        "session_id", "session_date", "url", "lang", "seq", F.coalesce("s.start", zero).alias("start_s"), F.coalesce("s.end", zero).alias("end_s"),
        F.coalesce("s.speaker", blank).alias("speaker"), F.coalesce("s.text", blank).alias("text"),
    )


def report_lines(spark: SparkSession, path: str, series: str) -> DataFrame:
    """Raw lines of delimited reports under ``path``, in the shape that the drift operator reads; files are numbered by name."""
    whole = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file_name"), "value")
    numbers = whole.select("file_name").distinct().withColumn("file_no", F.regexp_extract("file_name", r"S(\d+)", 1).cast("int"))
    lines = whole.join(numbers, "file_name").select("file_name", "file_no", F.posexplode(F.split("value", "\r?\n")).alias("i", "line_text"))
    return lines.select(
        F.xxhash64("file_name", "i").alias("line_id"), F.lit(series).alias("series"), "file_no", "file_name", (F.col("i") + 1).alias("line_no"), "line_text"
    )
