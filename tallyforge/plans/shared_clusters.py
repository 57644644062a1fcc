"""k-means for a range of cluster numbers, all fitted by the same scans.

A scan places every row in all sets of centres at once and leaves one sum per cluster and task.
The distance of a row to the nearest centre of the largest set bounds, by the triangle inequality,
its distances to all other centres, most of which are therefore never computed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType

from ..session import persisted

#: Scans that look for places to start from, and rows that each picks per cluster of the largest k.
ROUNDS, PICKED = 3, 4
#: Ways to start that are tried on those places, without a scan.
TRIES = 24


def _points(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres, from differences: exact for equal points."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)


class _Sets:
    """Several sets of centres, the first of which is the largest."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.gaps = [np.sqrt(_squares(sets[0], other)) for other in sets[1:]]

    def place(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], int]:
        """For each set the nearest centre of every point and the squared distance to it, and
        how many distances were computed."""
        near = _squares(x, self.sets[0])
        lead = near.argmin(axis=1)
        square = near[np.arange(len(x)), lead]
        reach = np.sqrt(square)
        labels, squares, made = [lead], [square], near.size
        groups = [np.flatnonzero(lead == a) for a in range(len(self.sets[0]))]
        for centres, gaps in zip(self.sets[1:], self.gaps):
            label, best = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
            for a, rows in enumerate(groups):
                for c in np.argsort(gaps[a], kind="stable"):
                    # No point of the rest can be nearer to c, or to the centres behind it.
                    rows = rows[gaps[a, c] - reach[rows] <= np.sqrt(best[rows]) * (1 + 1e-12)]
                    if not len(rows):
                        break
                    d = ((x[rows] - centres[c]) ** 2).sum(axis=1)
                    made += len(rows)
                    nearer = d < best[rows]
                    best[rows[nearer]], label[rows[nearer]] = d[nearer], c
            labels.append(label)
            squares.append(best)
        return labels, squares, made


def _summing(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: _Sets = shared.value
        width = sets.sets[0].shape[1]
        # Columns: rows, squared distances, sums of the values.
        totals = [np.zeros((len(c), 2 + width)) for c in sets.sets]
        made = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch)
            labels, squares, more = sets.place(x)
            made += more
            for total, label, square in zip(totals, labels, squares):
                for c in np.unique(label):
                    own = label == c
                    total[c, 0] += own.sum()
                    total[c, 1] += square[own].sum()
                    total[c, 2:] += x[own].sum(axis=0)
        rows = [(s, c, row) for s, total in enumerate(totals) for c, row in enumerate(total) if row[0]]
        rows.append((-1, 0, np.array([made])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64()))],
            names=["s", "c", "v"],
        )

    return run


def _totals(kept: DataFrame, sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Rows, squared distances and sums per centre of each set, from one scan; and the distances
    that it computed. The driver gets one row per centre and column, whatever the data."""
    shared = kept.sparkSession.sparkContext.broadcast(_Sets(sets))
    parts = kept.mapInArrow(_summing(shared), "s int, c int, v array<double>")
    sums = parts.select("s", "c", F.posexplode("v").alias("d", "v")).groupBy("s", "c", "d").agg(F.sum("v").alias("v"))
    out, made = [np.zeros((len(c), 2 + c.shape[1])) for c in sets], 0
    for r in sums.collect():
        if r["s"] < 0:
            made = int(r["v"])
        else:
            out[r["s"]][r["c"], r["d"]] = r["v"]
    return out, made


def _far_points(kept: DataFrame, chosen: np.ndarray, many: int, seed: int) -> np.ndarray:
    """``many`` rows drawn by their squared distance to the chosen ones: those with the smallest
    exponential variables at that rate. Every task hands on its own ``many``."""
    shared = kept.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng([seed, len(shared.value), TaskContext.get().partitionId()])
        keys, rows = np.zeros(0), np.zeros((0, shared.value.shape[1]))
        for batch in batches:
            x = _points(batch)
            square = np.full(len(x), np.inf)
            for c in shared.value:
                np.minimum(square, ((x - c) ** 2).sum(axis=1), out=square)
            apart = square > 0
            keys = np.concatenate([keys, draw.exponential(size=int(apart.sum())) / square[apart]])
            rows = np.concatenate([rows, x[apart]])
            best = np.argsort(keys, kind="stable")[:many]
            keys, rows = keys[best], rows[best]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(rows.tolist(), pa.list_(pa.float64()))], names=["key", "x"])

    found = kept.mapInArrow(run, "key double, x array<double>").orderBy("key").limit(many).collect()
    return np.array([r["x"] for r in found]).reshape(len(found), chosen.shape[1])


def _start(points: np.ndarray, weight: np.ndarray, k: int, draw: np.random.Generator) -> tuple[float, np.ndarray]:
    """k-means of a few weighted points: (cost, centres), begun at points far from each other."""
    centres = points[[draw.choice(len(points), p=weight / weight.sum())]]
    while len(centres) < k:
        pull = weight * _squares(points, centres).min(axis=1)
        if not pull.sum() > 0:
            break
        centres = np.vstack([centres, points[draw.choice(len(points), p=pull / pull.sum())]])
    for _ in range(50):
        near = _squares(points, centres).argmin(axis=1)
        mass = np.bincount(near, weight, len(centres))
        held = mass > 0
        moved = centres.copy()
        moved[held] = np.stack([np.bincount(near, weight * points[:, d], len(centres))[held] / mass[held] for d in range(points.shape[1])], axis=1)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return float((weight * _squares(points, centres).min(axis=1)).sum()), centres


def _silhouettes(kept: DataFrame, sets: list[np.ndarray], totals: list[np.ndarray]) -> list[float]:
    """Mean silhouette with squared distances of each set, from one scan: the mean squared
    distance of a row to a cluster follows from the cluster's size, mean and spread."""
    spread = [np.divide(t[:, 1], t[:, 0], out=np.zeros(len(t)), where=t[:, 0] > 0) for t in totals]
    size = [t[:, 0] for t in totals]
    shared = kept.sparkSession.sparkContext.broadcast((_Sets(sets), spread, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placed, around, sizes = shared.value
        scores = np.zeros(len(sizes))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch)
            for s, label in enumerate(placed.place(x)[0]):
                mean = _squares(x, placed.sets[s]) + around[s]
                mean[:, sizes[s] == 0] = np.inf
                own, at = sizes[s][label], np.arange(len(x))
                inside = mean[at, label] * own / np.maximum(own - 1, 1)
                mean[at, label] = np.inf
                outside = mean.min(axis=1)
                value = np.divide(outside - inside, np.maximum(inside, outside), out=np.zeros(len(x)), where=np.isfinite(outside) & (np.maximum(inside, outside) > 0))
                scores[s] += np.where(own > 1, value, 0.0).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(scores)), pa.int32()), pa.array(scores)], names=["s", "score"])

    rows = kept.mapInArrow(run, "s int, score double").groupBy("s").agg(F.sum("score").alias("score")).collect()
    score = {r["s"]: r["score"] for r in rows}
    return [score[s] / n.sum() for s, n in enumerate(size)]


def kmeans_shared(
    df: DataFrame, features: str = "features", ks: Iterable[int] = range(2, 9), seed: int = 42,
    rounds: int = 40, tolerance: float = 1e-4, restarts: int = 3,
) -> DataFrame:
    """(k, sse, silhouette, sizes, centres, scans, distances), one row per number of clusters.

    ``features`` is a vector or an array of numbers, of one width. Rows where it is null or holds
    what is no finite number take no part; repeated rows count as often as they stand there, and
    nothing is left of no rows. Of ``restarts`` sets per k the one with the smallest sse stays.
    With fewer different rows than k there are fewer clusters, as many as ``sizes`` has entries.

    ``scans`` counts the passes over the data and ``distances`` what they computed, both for the
    whole sweep. A set that no longer moves by more than ``tolerance`` is not carried along.
    """
    spark, ks = df.sparkSession, sorted(set(ks))
    if not ks or ks[0] < 1:
        raise ValueError("numbers of clusters begin at 1")
    schema = "k int, sse double, silhouette double, sizes array<bigint>, centres array<array<double>>, scans int, distances bigint"
    values = F.col(features) if isinstance(df.schema[features].dataType, ArrayType) else vector_to_array(features)
    sound = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(values.cast("array<double>").alias("x")).where("x is not null").where(sound)
    with persisted(rows) as kept:
        one = kept.agg(F.min_by("x", F.xxhash64("x", F.lit(seed))).alias("x")).first()["x"]
        if one is None:
            return spark.createDataFrame([], schema)
        places, scans, made = np.array([one]), 1, 0
        for _ in range(ROUNDS):
            places = np.vstack([places, _far_points(kept, places, PICKED * ks[-1], seed)])
            scans += 1
        places = np.unique(places, axis=0)
        (weighed,), more = _totals(kept, [places])
        scans, made = scans + 1, made + more

        sets: list[np.ndarray] = []
        for k in ks:
            draw = np.random.default_rng([seed, k])
            tried = sorted((_start(places, weighed[:, 0], k, draw) for _ in range(TRIES)), key=lambda found: found[0])
            sets += [centres for _, centres in tried[:: max(1, TRIES // (2 * restarts))][:restarts]]
        own = [k for k in ks for _ in range(restarts)]
        live = list(range(len(sets)))
        for _ in range(rounds):
            live.sort(key=lambda s: -len(sets[s]))
            totals, more = _totals(kept, [sets[s] for s in live])
            scans, made, still = scans + 1, made + more, []
            for s, total in zip(live, totals):
                held = total[:, 0] > 0
                moved = sets[s].copy()
                moved[held] = total[held, 2:] / total[held, :1]
                far = ((moved - sets[s]) ** 2).sum(axis=1).max()
                sets[s] = moved
                if far > tolerance**2:
                    still.append(s)
            live = still
            if not live:
                break
        order = sorted(range(len(sets)), key=lambda s: -len(sets[s]))
        totals, more = _totals(kept, [sets[s] for s in order])
        made, best = made + more, {}
        for s, total in zip(order, totals):
            if own[s] not in best or total[:, 1].sum() < best[own[s]][1][:, 1].sum():
                best[own[s]] = (sets[s], total)
        chosen = sorted(best, reverse=True)
        scores = _silhouettes(kept, [best[k][0] for k in chosen], [best[k][1] for k in chosen])
        scans += 2
        out = []
        for k, score in zip(chosen, scores):
            centres, total = best[k]
            held = total[:, 0] > 0
            out.append((k, float(total[:, 1].sum()), float(score), [int(n) for n in total[held, 0]], centres[held].tolist(), scans, made))
    return spark.createDataFrame(sorted(out), schema)
