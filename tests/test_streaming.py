"""Every streamed result must equal the batch result over the same rows."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from tallyforge.sources.streams import table_stream
from tallyforge.streaming import windows as W
from tallyforge.streaming.enrich import enrich_stream
from tallyforge.streaming.sinks import append_stream, latest_rows, upsert_stream

from .fixtures import rows

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A table of five files, so that five micro-batches touch the same windows."""
    path = str(tmp_path_factory.mktemp("stream"))
    seconds = [(i * 37) % 5000 for i in range(400)]
    events = [
        (i, START + dt.timedelta(seconds=s), "A" if i % 3 else "B") for i, s in enumerate(seconds)
    ]
    df = spark.createDataFrame(events, "id long, ts timestamp_ntz, kind string")
    df.repartition(5, "id").write.parquet(f"{path}/events.parquet")
    return path


def stream_of(spark, folder):
    return table_stream(spark, folder, "events", max_files=1)


def batch_of(spark, folder):
    return spark.read.parquet(f"{folder}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def finish(query):
    query.awaitTermination()
    return query


def test_replay_reads_only_its_own_table(spark, folder, tmp_path):
    spark.range(1).write.parquet(f"{folder}/events_old.parquet")
    query = append_stream(stream_of(spark, folder), str(tmp_path / "out"), str(tmp_path / "cp"))
    finish(query)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(rows(found)) == sorted(rows(batch_of(spark, folder)))


@pytest.mark.parametrize("slide", [None, "20 seconds"])
def test_upserted_windows(spark, folder, tmp_path, slide):
    path = str(tmp_path / "log")
    counts = W.window_counts(stream_of(spark, folder), "ts", "kind", "1 minute", slide)
    finish(upsert_stream(counts, path, str(tmp_path / "cp")))
    assert len(list((tmp_path / "log").glob("batch_id=*"))) >= 5
    found = latest_rows(spark, path, ["start", "end", "kind"])
    expected = W.window_counts(batch_of(spark, folder), "ts", "kind", "1 minute", slide)
    assert found.columns == expected.columns
    assert sorted(rows(found)) == sorted(rows(expected))


def test_panes_give_the_sliding_windows(spark, folder, tmp_path):
    panes = W.pane_counts(stream_of(spark, folder), "ts", "kind", "1 minute")
    finish(upsert_stream(panes, str(tmp_path / "log"), str(tmp_path / "cp")))
    table = latest_rows(spark, str(tmp_path / "log"), ["pane", "kind"])
    found = W.rank_batch(W.slide_panes(table, "kind", "60 minutes", "1 minute"), "kind")
    expected = W.window_counts(batch_of(spark, folder), "ts", "kind", "60 minutes", "1 minute")
    got = rows(found)
    assert sorted(got) == sorted(rows(expected))
    assert got == sorted(got, key=lambda r: (r[0], -r[3], r[2]))


def test_repeated_batch_changes_nothing(spark, folder, tmp_path):
    """A batch written twice, as after a failure, replaces its own rows only."""
    path, cp = str(tmp_path / "log"), tmp_path / "cp"
    panes = W.pane_counts(stream_of(spark, folder), "ts", "kind", "1 minute")
    finish(upsert_stream(panes, path, str(cp)))
    before = sorted(rows(latest_rows(spark, path, ["pane", "kind"])))
    # The checkpoint as it is when the job dies after writing the last batch.
    last = max(int(p.name) for p in (cp / "commits").iterdir() if p.name.isdigit())
    lost = {str(last), f".{last}.crc"}
    skip = lambda folder, names: lost & set(names) if folder.endswith("commits") else ()
    dead = shutil.copytree(cp, tmp_path / "dead", ignore=skip)
    finish(upsert_stream(panes, path, str(dead)))
    assert (dead / "commits" / str(last)).exists()
    assert sorted(rows(latest_rows(spark, path, ["pane", "kind"]))) == before


def test_restart_takes_new_rows_only(spark, tmp_path):
    source = str(tmp_path / "in")
    events = spark.createDataFrame([(START, "A")], "ts timestamp_ntz, kind string")
    events.write.mode("append").parquet(f"{source}/events.parquet")
    path, cp = str(tmp_path / "log"), str(tmp_path / "cp")
    for expected in (1, 2):
        counts = W.window_counts(table_stream(spark, source, "events"), "ts", "kind", "1 minute")
        finish(upsert_stream(counts, path, cp))
        assert [r[3] for r in rows(latest_rows(spark, path, ["start", "end", "kind"]))] == [expected]
        events.write.mode("append").parquet(f"{source}/events.parquet")


def seconds_rows(spark):
    times = [10, 50, 190]
    return spark.createDataFrame(
        [(bytearray(b"A"), START + dt.timedelta(seconds=s)) for s in times],
        "value binary, timestamp timestamp",
    )


def test_seconds_watched(spark):
    df = seconds_rows(spark)
    df.createOrReplaceTempView("seconds_rows")
    for found in (W.seconds_watched(df), W.seconds_watched_sql(spark, "seconds_rows")):
        flat = found.select("window.start", "window.end", "course_name", "seconds_watched")
        two = dt.timedelta(minutes=2)
        assert sorted(rows(flat)) == [(START, START + two, "A", 10), (START + two, START + 2 * two, "A", 5)]


def test_appended_windows_are_those_behind_the_watermark(spark, folder, tmp_path):
    batch = spark.read.parquet(f"{folder}/events.parquet")
    for hour in (0, 1):
        part = batch.filter(F.hour("ts") == hour).coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/in/events.parquet")
    counts = W.window_counts(
        stream_of(spark, f"{tmp_path}/in"), "ts", "kind", "10 minutes", watermark="10 minutes"
    )
    finish(append_stream(counts, str(tmp_path / "out"), str(tmp_path / "cp")))
    batch = batch_of(spark, folder)
    limit = batch.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    expected = W.window_counts(batch, "ts", "kind", "10 minutes").filter(F.col("end") <= F.lit(limit))
    found = rows(spark.read.parquet(str(tmp_path / "out")))
    assert len(found) == 14 and sorted(found) == sorted(rows(expected))


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_enriched_stream(spark, folder, tmp_path, max_rows):
    names = spark.createDataFrame([("A", "first")], "kind string, name string")
    query = enrich_stream(
        stream_of(spark, folder), names, "kind", str(tmp_path / "out"), str(tmp_path / "cp"),
        max_rows=max_rows,
    )
    finish(query)
    found = spark.read.parquet(str(tmp_path / "out")).select("id", "kind", "name")
    expected = batch_of(spark, folder).join(names, "kind", "left").select("id", "kind", "name")
    assert sorted(rows(found), key=repr) == sorted(rows(expected), key=repr)


def test_continuous_query(spark, folder, tmp_path):
    counts = W.window_counts(stream_of(spark, folder), "ts", "kind", "1 hour")
    query = upsert_stream(counts, str(tmp_path / "log"), str(tmp_path / "cp"), every="1 second")
    try:
        query.processAllAvailable()
        found = latest_rows(spark, str(tmp_path / "log"), ["start", "end", "kind"])
        assert found.agg(F.sum("count")).first()[0] == 400
        assert query.isActive
    finally:
        query.stop()


def test_ordered_batches(spark, folder, tmp_path):
    counts = W.window_counts(table_stream(spark, folder, "events"), "ts", "kind", "1 hour")
    order = lambda batch: W.rank_batch(batch, "kind").coalesce(1)
    finish(upsert_stream(counts, str(tmp_path / "log"), str(tmp_path / "cp"), order=order))
    got = [(r["start"], -r["count"]) for r in spark.read.parquet(str(tmp_path / "log" / "batch_id=0")).collect()]
    assert len(got) > 2 and got == sorted(got)


@pytest.mark.parametrize("size,slide,per_range", [("1 minute", "20 seconds", 4096), ("10 minutes", "10 seconds", 7), ("20 seconds", "20 seconds", 3)])
def test_difference_events_are_sliding_windows(spark, folder, size, slide, per_range):
    """Gaps, several ranges, null keys, times before 1970."""
    late = [(1, dt.datetime(2024, 1, 3), "A"), (2, dt.datetime(1969, 12, 31, 23, 59, 55), None), (3, dt.datetime(1969, 12, 31, 23, 59), "B")]
    table = batch_of(spark, folder).union(spark.createDataFrame(late, "id long, ts timestamp, kind string"))
    panes = W.pane_counts(table, "ts", "kind", slide)
    found = W.slide_differences(panes, "kind", size, slide, per_range)
    expected = W.window_counts(table, "ts", "kind", size, slide)
    assert found.columns == expected.columns and sorted(rows(found), key=repr) == sorted(rows(expected), key=repr)


def test_difference_events_of_nothing(spark):
    panes = spark.createDataFrame([], "pane timestamp, kind string, count long")
    assert W.slide_differences(panes, "kind", "1 minute", "20 seconds").count() == 0
    with pytest.raises(ValueError):
        W.slide_differences(panes, "kind", "50 seconds", "20 seconds")
