"""Compacted change logs: bounded reads, nothing lost."""

import random

import pytest
from pyspark.sql import functions as F

from tallyforge.sources.streams import table_stream
from tallyforge.streaming import compaction, sinks, windows
from tallyforge.streaming.sinks import latest_rows


class Log:
    """A change log written by hand, with what its table should be."""

    def __init__(self, spark, path, seed=1):
        self.spark, self.path, self.table, self.n, self.random = spark, str(path), {}, 0, random.Random(seed)

    def batch(self, size=3):
        rows = {self.random.randrange(20): self.random.randrange(1000) for _ in range(size)}
        self.table.update(rows)
        self.spark.createDataFrame(list(rows.items()), "k long, v long").coalesce(1).write.parquet(f"{self.path}/batch_id={self.n}")
        self.n += 1

    def found(self):
        return {r.k: r.v for r in latest_rows(self.spark, self.path, ["k"]).collect()}


def opened(spark, log):
    """Folders that a reader opens."""
    return {f.rsplit("/", 1)[0] for f in compaction.read_log(spark, log.path).inputFiles()}


def test_reads_stay_bounded(spark, tmp_path):
    """Each key's last row survives every merge; folders opened grow with the logarithm."""
    log = Log(spark, tmp_path / "log")
    most = 0
    for n in range(70):
        log.batch()
        compaction.compact(spark, log.path, ["k"], fanout=3)
        if n % 9 == 4 or n > 66:
            assert log.found() == log.table
            most = max(most, len(opened(spark, log)))
    now = compaction.manifest(spark, log.path)
    assert max(level for level, _ in now.runs) >= 3 and most <= 3 + 2 * 4
    # A row is kept once per run at most, and replaced folders are gone but for the last ones.
    assert compaction.read_log(spark, log.path).count() <= 20 * len(now.runs) + 9
    assert len(list((tmp_path / "log").glob("batch_id=*"))) <= 2 * 3 + 2
    assert len(list((tmp_path / "log_runs").glob("*.json"))) <= 2


@pytest.mark.parametrize("killed_at", ["write", "rename", "delete"])
def test_a_killed_compaction_loses_nothing(spark, tmp_path, monkeypatch, killed_at):
    log = Log(spark, tmp_path / "log", 2)
    for _ in range(4):
        log.batch()
        compaction.compact(spark, log.path, ["k"], fanout=2)

    def killed(*_):
        raise KeyboardInterrupt

    log.batch()
    log.batch()
    with monkeypatch.context() as m:
        if killed_at == "write":
            m.setattr(compaction, "_last_of_each", killed)
        else:
            m.setattr(compaction._Files, "write" if killed_at == "rename" else "delete", killed)
        with pytest.raises(KeyboardInterrupt):
            compaction.compact(spark, log.path, ["k"], fanout=2)
    assert log.found() == log.table
    for _ in range(5):
        log.batch()
        compaction.compact(spark, log.path, ["k"], fanout=2)
        assert log.found() == log.table


def test_unfinished_batches_are_left_alone(spark, tmp_path):
    """The batch that is being written, and one written again after a restart."""
    log = Log(spark, tmp_path / "log", 3)
    for _ in range(3):
        log.batch()
    now = compaction.compact(spark, log.path, ["k"], before=2, fanout=2)
    assert now.upto == 1 and log.found() == log.table
    log.spark.createDataFrame([(1, -1)], "k long, v long").write.mode("overwrite").parquet(f"{log.path}/batch_id=2")
    assert log.found()[1] == -1
    assert compaction.compact(spark, log.path, ["k"], before=3, fanout=2) == now


def test_a_stream_compacts_its_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction.compact, "__defaults__", (None, 2))
    rows = spark.range(120).select((F.col("id") % 7).cast("string").alias("kind"), F.timestamp_seconds(F.col("id") * 5).cast("timestamp_ntz").alias("ts"))
    rows.repartition(12).write.parquet(f"{tmp_path}/events.parquet")
    stream = table_stream(spark, str(tmp_path), "events", max_files=1)
    counts = windows.window_counts(stream, "ts", "kind", "1 minute")
    keys = ["start", "end", "kind"]
    sinks.upsert_stream(counts, f"{tmp_path}/log", f"{tmp_path}/cp", keys=keys).awaitTermination()
    assert compaction.manifest(spark, f"{tmp_path}/log").number >= 3
    batch = windows.window_counts(rows.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "kind", "1 minute")
    assert sorted(map(tuple, latest_rows(spark, f"{tmp_path}/log", keys).select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
