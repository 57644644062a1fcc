"""Levelled compaction of a change log.

A log is a folder with one subfolder per micro-batch (``batch_id=7``). Compaction merges FANOUT
finished batches to a run of level 1, in which each key has its last row only, FANOUT runs of a
level to one of the next, and so on: some FANOUT runs per level and FANOUT young batches are all
that a reader opens, and a row is rewritten once per level.

Runs lie in ``<path>_runs``. Which of them count is said by manifests, numbered files that are
written under another name and renamed last. A compaction that is killed leaves files that no
manifest names; batches and runs that a new manifest replaces are deleted by the compaction
after it, so that readers of the manifest before can finish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH = "batch_id"
FANOUT = 10


@dataclass
class Manifest:
    """``runs`` are (level, folder name) from the oldest on; they cover all batches up to
    ``upto``. ``old`` are folders that are to go with the next compaction."""

    number: int = 0
    upto: int = -1
    runs: list[tuple[int, str]] = field(default_factory=list)
    old: list[str] = field(default_factory=list)


class _Files:
    """The file system of a path, through Spark's own."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        where = self._path(path)
        return [f.getPath().getName() for f in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Under another name first: the file is there whole or not at all."""
        part = self._path(f"{path}.{uuid.uuid4().hex}.part")
        stream = self.fs.create(part)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if not self.fs.rename(part, self._path(path)):
            raise OSError(f"{path} could not be written: another compaction of the same log?")

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


def _runs(path: str) -> str:
    return path.rstrip("/") + "_runs"


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest one; an empty one for a log that was never compacted."""
    files, folder = _Files(spark, path), _runs(path)
    numbers = [int(n.removesuffix(".json")) for n in files.names(folder) if n.endswith(".json")]
    if not numbers:
        return Manifest()
    found = json.loads(files.read(f"{folder}/{max(numbers)}.json"))
    return Manifest(found["number"], found["upto"], [tuple(r) for r in found["runs"]], found["old"])


def _batches(files: _Files, path: str) -> list[int]:
    return sorted(int(n.removeprefix(f"{BATCH}=")) for n in files.names(path) if n.startswith(f"{BATCH}="))


def _rows(spark: SparkSession, path: str, batches: Sequence[int], runs: Sequence[str]) -> list[DataFrame]:
    found = []
    if batches:
        young = spark.read.option("basePath", path).parquet(*[f"{path}/{BATCH}={n}" for n in batches])
        found.append(young.withColumn(BATCH, F.col(BATCH).cast("bigint")))
    if runs:
        found.append(spark.read.parquet(*[f"{_runs(path)}/{name}" for name in runs]))
    return found


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows that may still count, with their ``batch_id``."""
    now = manifest(spark, path)
    if not now.runs:
        return spark.read.parquet(path)
    young = [n for n in _batches(_Files(spark, path), path) if n > now.upto]
    first, *rest = _rows(spark, path, young, [name for _, name in now.runs])
    return first.unionByName(rest[0]) if rest else first


def _last_of_each(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in log.columns if c not in keys and c != BATCH]
    return log.groupBy(*keys).agg(*[F.max_by(v, BATCH).alias(v) for v in values], F.max(BATCH).alias(BATCH))


def compact(spark: SparkSession, path: str, keys: Sequence[str], before: int | None = None, fanout: int = FANOUT) -> Manifest:
    """Merge what is due: young batches (those under ``before``, which are finished) once there
    are ``fanout`` of them, then runs of a level once there are ``fanout`` of it. Returns the
    manifest that counts afterwards. One compaction of a log at a time; readers may go on."""
    if fanout < 2:
        raise ValueError("a run is merged from two others at least")
    files, folder, now = _Files(spark, path), _runs(path), manifest(spark, path)
    done = [n for n in _batches(files, path) if n > now.upto and (before is None or n < before)]
    if len(done) < fanout:
        return now
    runs, merged = list(now.runs), [(0, f"{BATCH}={n}") for n in done]
    level, batches, names = 1, done, []
    # One merge takes the batches and every level that becomes full with the new run.
    while sum(1 for own, _ in runs if own == level) + 1 >= fanout:
        full = [r for r in runs if r[0] == level]
        names += [name for _, name in full]
        runs = [r for r in runs if r[0] != level]
        level += 1
    first, *rest = _rows(spark, path, batches, names)
    log = first.unionByName(rest[0]) if rest else first
    name = f"level-{level}-{done[-1]}-{uuid.uuid4().hex}"
    _last_of_each(log, keys).write.parquet(f"{folder}/{name}")
    old = [f"{path}/{n}" for _, n in merged] + [f"{folder}/{n}" for n in names]
    after = Manifest(now.number + 1, done[-1], [*runs, (level, name)], old)
    files.write(f"{folder}/{after.number}.json", json.dumps(asdict(after)))
    for gone in now.old:
        files.delete(gone)
    if now.number > 1:
        files.delete(f"{folder}/{now.number - 1}.json")
    return after
