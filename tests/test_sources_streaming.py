import json

from sagaloom.operators import drift
from sagaloom.sources import files
from sagaloom.sources.tables import table
from sagaloom.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_transcripts_and_reports(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "2024-01-01_x.json").write_text(json.dumps({"video_date": "2024-01-01", "segments": [{"start": 1.5, "text": "Hallo"}, {"speaker": "A", "end": 2}]}))
    rows = sorted(files.transcripts(spark, str(tmp_path / "t")).collect(), key=lambda r: r.seq)
    assert [(r.session_id, r.lang, r.start_s, r.end_s, r.speaker, r.text) for r in rows] == [("2024-01-01_x", "de", 1.5, 0.0, "", "Hallo"), ("2024-01-01_x", "de", 0.0, 2.0, "A", "")]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "R_S01.csv").write_text("a;b\n1;x\n2;y\n")
    (tmp_path / "r" / "R_S02.csv").write_text("a;b;c\r\n1;x;5\r\n")
    changes = drift.field_changes(files.report_lines(spark, str(tmp_path / "r"), "R"))
    assert [tuple(r)[3:] for r in changes.collect()] == [("added", "", "c")]


def run(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return df.sparkSession.table(name).collect()


def test_window_counts_equal_batch(spark):
    got = run(ingest.window_counts(ingest.table_stream(spark, SF, "events"), "ts", "event_type", "1 hour", "1 day"), "hours", "complete")
    assert sum(r.n_rows for r in got) == table(spark, SF, "events").count()


def test_closed_versions(spark, tmp_path):
    path = str(tmp_path / "c")
    schema = "k string, v string, m string"
    for i, rows in enumerate([[("a", "x", "1"), ("a", "x", "2"), ("b", "y", "1"), (None, "z", "1")], [("a", "z", "3"), ("a", "w", "0"), ("b", None, "2")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        if i == 0:
            first = set(map(str, (tmp_path / "c").glob("*.parquet")))
    assert first
    import os
    import time

    for f in (tmp_path / "c").glob("*.parquet"):  # the stream takes files by age
        os.utime(f, (time.time() - (100 if str(f) in first else 50),) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = run(ingest.closed_versions(stream, "k", "v", "m"), "closed", "append")
    assert [tuple(r) for r in got] == [("a", "x", "1", "3")]
