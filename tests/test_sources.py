import time
from pathlib import Path

import pyarrow as pa
import pyspark.sql.functions as F
import pytest

from tallyforge import session
from tallyforge.operators.split import marked_split
from tallyforge.plans import tuning
from tallyforge.plans import files as jobs
from tallyforge.session import arrow_rows, checkpoint_root, scratch_path, shuffle_partitions
from tallyforge.sources import streams, tables

from .fixtures import CHAPTERS, TITLES, VIEWS, rows


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", ["id,name,score", "1,x,2.5", "2,,3"])
    assert tables.read_csv(spark, path).dtypes == [("id", "string"), ("name", "string"), ("score", "string")]
    inferred = tables.read_csv(spark, path, infer=True)
    assert inferred.dtypes == [("id", "int"), ("name", "string"), ("score", "double")]
    typed = tables.read_csv(spark, path, "id long, name string, score double")
    assert sorted(rows(typed), key=lambda r: r[0]) == [(1, "x", 2.5), (2, None, 3.0)]


def test_csv_glob(spark, tmp_path):
    write(tmp_path / "views-1.csv", ["a", "1"])
    write(tmp_path / "views-2.csv", ["a", "2"])
    write(tmp_path / "other.csv", ["a", "3"])
    found = tables.read_csv(spark, str(tmp_path / "views-*.csv"), "a int")
    assert sorted(rows(found)) == [(1,), (2,)]


def test_delimited_text(spark, tmp_path):
    path = write(tmp_path / "views.csv", ["14,96,2017-01-01,more", "13,97,2017-01-02"])
    found = tables.read_delimited(spark, path, "userId int, chapterId int")
    assert found.dtypes == [("userId", "int"), ("chapterId", "int")]
    assert sorted(rows(found)) == [(13, 97), (14, 96)]


@pytest.mark.parametrize("line", ["x,96", "14"])
def test_malformed_delimited_text_fails(spark, tmp_path, line):
    path = write(tmp_path / "views.csv", ["14,96", line])
    with pytest.raises(Exception):
        tables.read_delimited(spark, path, "userId int, chapterId int").collect()


def test_file_jobs(spark, tmp_path):
    logs = write(
        tmp_path / "log.txt",
        ["level,datetime", "WARN,2016-12-31 04:19:32", "FATAL,2016-01-31 03:22:34", "WARN,2016-12-01 00:00:00"],
    )
    assert rows(jobs.log_months(spark, logs)) == [("FATAL", "January", 1), ("WARN", "December", 2)]
    by_level = {r["level"]: r for r in jobs.log_month_table(spark, logs).collect()}
    assert by_level["WARN"]["December"] == 2 and by_level["FATAL"]["December"] == 0
    sizes = dict(rows(jobs.log_level_sizes(spark, logs)))
    assert sizes == {"level": 1, "WARN": 2, "FATAL": 1}

    steps = {r[0]: r[1:] for r in rows(jobs.log_partitions(spark, logs))}
    assert steps["lines"] == steps["narrow"] == (1, 4)
    assert steps["wide"][1] == 3 and 1 <= steps["wide"][0] <= 4

    exams = write(tmp_path / "exams.csv", ["student_id,subject,year,score", "1,Math,2005,10", "2,Math,2005,20"])
    assert rows(jobs.exam_results(spark, exams)) == [("Math", 15.0, 7.07)]

    text = write(tmp_path / "input.txt", ["1", "00:00 --> 00:05", "The docker, the Docker!"])
    stop = write(tmp_path / "stop.txt", ["the", "of"])
    assert rows(jobs.frequent_words(spark, text, stop)) == [("docker", 2)]
    assert rows(jobs.frequent_words(spark, text, n=1)) == [("docker", 2)]

    ratings = write(tmp_path / "ratings.csv", ["userId,courseId,proportionWatched", "1,2,0.25"])
    assert rows(jobs.course_ratings(spark, ratings)) == [(1, 2, 25.0)]


def test_popularity_from_files(spark, tmp_path):
    views = write(tmp_path / "views-1.csv", [f"{u},{c},2017-01-01 00:00:00" for u, c in VIEWS])
    chapters = write(tmp_path / "chapters.csv", [f"{c},{k}" for c, k in CHAPTERS])
    titles = write(tmp_path / "titles.csv", [f"{k},{t}" for k, t in TITLES])
    found = jobs.course_popularity(spark, views.replace("-1", "-*"), chapters, titles)
    assert [r[1] for r in rows(found)] == [10, 6, 0]


def test_stream_options(spark):
    assert streams.kafka_options("host:9092", "views") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "views",
        "startingOffsets": "latest",
    }
    assert streams.socket_options("host", 8989)["port"] == "8989"
    rate = streams.event_stream(spark, "rate", {"rowsPerSecond": "1"})
    assert rate.isStreaming and rate.columns == ["value", "timestamp"]


def test_scratch_paths_are_new_and_shared(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_root(spark))


def test_arrow_batches_are_bounded_and_put_back(spark):
    def longest():
        sizes = spark.range(0, 100, 1, 1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"id": [b.num_rows]}) for b in batches), "id long")
        return max(r["id"] for r in sizes.collect())

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with pytest.raises(ZeroDivisionError), arrow_rows(spark, 30):
        assert longest() == 30
        1 / 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before and longest() == 100


def test_shuffle_partitions_are_put_back(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffle_partitions(spark, 10):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
    assert spark.conf.get("spark.sql.shuffle.partitions") == old


def test_persisted_tables_keep_their_partitions(spark):
    with session.persisted(spark.range(0, 150, 1, 3)) as kept:
        assert kept.is_cached and kept.count() == 150
        assert kept.rdd.getNumPartitions() == 3
    assert not kept.is_cached


def test_parallel_results_keep_their_order(spark):
    found = session.in_parallel(spark, lambda n: spark.range(n).count(), [5, 0, 3, 9], 3)
    assert found == [5, 0, 3, 9]
    assert session.in_parallel(spark, str, [], 4) == []


def _estimate(df):
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def test_checkpointed_table_has_no_lineage(spark):
    df = session.checkpointed(spark.range(10).selectExpr("id % 3 AS k").distinct())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Relation") and df.count() == 3


def test_estimates_stay_small_in_a_loop(spark):
    """Every round joins a table with itself: the estimate must be that of the files."""
    df = spark.range(100).selectExpr("id", "id % 10 AS k")
    for _ in range(20):
        other = df.selectExpr("id AS other", "k AS same")
        df = session.checkpointed(df.join(other, df.k == other.same).groupBy("id").agg(F.min("k").alias("k")))
    size = sum(f.stat().st_size for f in Path(df.inputFiles()[0].removeprefix("file:")).parent.glob("*.parquet"))
    assert df.count() == 100 and _estimate(df) <= 10 * size


def test_checkpointed_table_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for k in range(found.size()) if (name := found.apply(k).getName()).startswith("shuffle_")}

    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    setting = spark.conf.get(key)
    df = session.checkpointed(spark.range(1000).selectExpr("id % 30 AS k", "id").groupBy("k").agg(F.sum("id").alias("s")))
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left and df.count() == 30 and spark.conf.get(key) == setting


def test_checkpointed_table_keeps_types(spark):
    df = spark.sql("SELECT 1 AS `a b`, CAST('x' AS BINARY) AS raw, array(named_struct('c', 1.5D)) AS nested, DATE'2024-01-01' AS day WHERE 1 = 0")
    kept = session.checkpointed(df)
    assert kept.count() == 0 and kept.schema.simpleString() == df.schema.simpleString()


def test_kept_rows_are_passed_over_in_few_tasks(spark):
    """Each task of each pass sends something to the driver: a grid search over many small
    partitions does not take one task for each of them."""
    cores = spark.sparkContext.defaultParallelism
    for parts, per_task, tasks in ((200, 100_000, cores), (200, 10, 100), (3, 10, 3), (200, None, 200)):
        with session.persisted(spark.range(0, 1000, 1, parts), per_task) as kept:
            assert kept.rdd.getNumPartitions() == max(tasks, min(parts, cores)) and kept.count() == 1000


def test_grid_search_bounds_its_tasks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tuning, "marked_split", lambda df, *more: (seen.append(df.rdd.getNumPartitions()), marked_split(df, *more))[1])
    df = spark.range(0, 400, 1, 100).selectExpr("id", "id % 7 AS x", "CAST(id % 3 = 0 AS INT) AS y")
    for tune in (tuning.tune_logreg, tuning.tune_linreg, tuning.tune_linreg_pipeline):
        seen.clear()
        tune(df, "y", ["x"], reg=(0.1,), elastic=(0.0,), key="id")
        assert seen[0] <= spark.sparkContext.defaultParallelism
