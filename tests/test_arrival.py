"""Windows over the time of arrival: keys come, stay for the window, and vanish."""

import os
import subprocess
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallyforge.registry import QUERIES
from tallyforge.streaming.arrival import ArrivalPanes, arrival_counts, current_counts, start_arrivals
from tallyforge.streaming.durations import millis


def put(spark, folder, name, keys):
    spark.createDataFrame([(k,) for k in keys], "kind string").coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def watch(spark, path, wanted, seconds=40):
    """Wait for a state of the table."""
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        try:
            found = {r.kind: r["count"] for r in current_counts(spark, path, ["kind"]).collect()}
        except Exception as not_yet:  # no batch has been written so far
            if "PATH_NOT_FOUND" not in str(not_yet) and "UNABLE_TO_INFER_SCHEMA" not in str(not_yet):
                raise
            found = None
        if found == wanted:
            return found
        time.sleep(0.3)
    return found


def test_durations():
    assert (millis("2 seconds"), millis("1 minute"), millis(" 60 Minutes ")) == (2000, 60_000, 3_600_000)
    for wrong in ("", "two seconds", "3 fortnights", "0 seconds"):
        with pytest.raises(ValueError):
            millis(wrong)


def test_size_is_a_multiple(spark):
    with pytest.raises(ValueError):
        arrival_counts(spark.createDataFrame([], "kind string"), "kind", "5 seconds", "2 seconds")


def test_keys_vanish_and_survive_a_restart(spark, tmp_path):
    """Input with a gap: the window empties, the key goes, and comes back. A restart keeps what
    is in the window; what left it meanwhile goes after the restart."""
    folder, path, checkpoint = (str(tmp_path / x) for x in ("in", "log", "cp"))
    put(spark, folder, "a", ["x", "x", "y", None])
    stream = spark.readStream.schema("kind string").parquet(f"{folder}/*.parquet")

    def start(size):
        return start_arrivals(stream, "kind", size, "1 second", path, checkpoint)

    query = start("15 seconds")
    assert watch(spark, path, {"x": 2, "y": 1}) == {"x": 2, "y": 1}
    put(spark, folder, "b", ["x"])
    assert watch(spark, path, {"x": 3, "y": 1}) == {"x": 3, "y": 1}
    query.stop()
    query.awaitTermination()
    query = start("15 seconds")
    put(spark, folder, "c", ["z"])
    assert watch(spark, path, {"z": 1}) == {"z": 1}  # x and y have left the window
    assert watch(spark, path, {}) == {}
    put(spark, folder, "d", ["y", "y"])
    assert watch(spark, path, {"y": 2}) == {"y": 2}
    query.stop()
    query.awaitTermination()
    assert query.exception() is None


def test_processor_needs_no_import(tmp_path):
    """Spark's worker on the driver does not see what --py-files has sent to the tasks."""
    file = tmp_path / "processor"
    file.write_bytes(cloudpickle.dumps(ArrivalPanes("kind", 5, 1000)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    load = f"import sys; from pyspark import cloudpickle; p = cloudpickle.load(open({str(file)!r}, 'rb')); print(p.width, 'tallyforge' in sys.modules)"
    found = subprocess.run([sys.executable, "-c", load], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert found.stdout.split() == ["5", "False"], found.stderr


def test_query_in_a_session_with_another_state_store(spark, tmp_path):
    """As in a session that build_session has not made; a missing type is counted too."""
    rows = [("x",), ("x",), ("y",), ("",), (None,), (None,), (None,)]
    spark.createDataFrame(rows, "event_type string").withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, plain)
    try:
        found = QUERIES["arrival_views"](spark, str(tmp_path)).collect()
        assert spark.conf.get(key) == plain
    finally:
        spark.conf.set(key, old)
    assert {r.event_type: r["count"] for r in found} == {"x": 2, "y": 1, "": 1, None: 3}
