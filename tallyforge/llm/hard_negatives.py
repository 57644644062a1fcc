"""Hard negatives of anchors, by exact integer inner products.

Components are scaled and rounded down to integers. Anchors come in passes of a bounded size;
each task multiplies tiles of a pass with tiles of its candidates by Strassen's recursion on
int64 (odd sides are padded with zeros). Additions and products are exact modulo 2^64 and the
results fit, so they are exact. Every task keeps the best few of each anchor in heaps; heaps of
several tasks merge to that of all candidates. The first round finds the positives, whose scores
bound the windows that the second round fills with negatives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pyspark.sql.types as T
from pyspark.sql import DataFrame, Window

from tallyforge.session import checkpointed

#: Anchors of a pass take about so many bytes, as integers.
PASS_BYTES = 32 << 20
#: Sides of a tile: anchors, candidates.
TILE = (256, 4096)
#: Products with a side of at most so much are made directly.
LEAF = 32
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices, modulo 2^64, in seven products of half the sides."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    both = strassen(a11 + a22, b11 + b22)
    lower = strassen(a21 + a22, b11)
    right = strassen(a11, b12 - b22)
    left = strassen(a22, b21 - b11)
    upper = strassen(a11 + a12, b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = both + left - upper + strassen(a12 - a22, b21 + b22)
    out[:m, n:] = right + upper
    out[m:, :n] = lower + left
    out[m:, n:] = both - lower + right + strassen(a21 - a11, b11 + b12)
    return out


class Heaps:
    """The ``width`` best (score, id) of each slot: higher scores first, then smaller ids."""

    def __init__(self, slots: int, width: int):
        self.width = width
        self.score = np.full((slots, width), _NONE, np.int64)
        self.ids = np.full((slots, width), np.iinfo(np.int64).max, np.int64)

    @property
    def worst(self) -> np.ndarray:
        """What an entry of each slot must reach to be of use."""
        return self.score[:, -1]

    def merge(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        slot = np.concatenate([np.repeat(touched, self.width), slot])
        score = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, touched)
        place = first[:, None] + np.arange(self.width)
        self.score[touched], self.ids[touched] = score[place], ids[place]

    def rows(self) -> pa.RecordBatch:
        slot, place = np.nonzero(self.score != _NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(slot.astype(np.int64)), pa.array(self.score[slot, place]), pa.array(self.ids[slot, place])], names=["slot", "score", "id"]
        )


_ROWS = "slot bigint, score bigint, id bigint"


def integers(column: pa.Array, depth: int, scale: int) -> np.ndarray:
    """floor(scale * x) of lists of numbers, a row each, filled up with zeros to ``depth``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    flat = np.floor(scale * flat).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == depth).all():
        return flat.reshape(len(column), depth)
    out = np.zeros((len(column), depth), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _tiles(batches: Iterator[pa.RecordBatch], depth: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and integer vectors of up to TILE[1] candidates."""
    for batch in batches:
        for low in range(0, batch.num_rows, TILE[1]):
            part = batch.slice(low, TILE[1])
            yield part.column("id").to_numpy(), part.column("label").to_numpy(), integers(part.column("v"), depth, scale)


def _positives(shared, depth: int, scale: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, labels, points = shared.value
        best = Heaps(len(names), count)
        order = np.argsort(labels, kind="stable")
        ordered = labels[order]
        for ids, own, vectors in _tiles(batches, depth, scale):
            for label in np.unique(own):
                mine = order[np.searchsorted(ordered, label, "left") : np.searchsorted(ordered, label, "right")]
                if not len(mine):
                    continue
                cols = np.flatnonzero(own == label)
                right = np.ascontiguousarray(vectors[cols].T)
                for low in range(0, len(mine), TILE[0]):
                    rows = mine[low : low + TILE[0]]
                    score = strassen(points[rows], right)
                    r, c = np.nonzero((score >= best.worst[rows, None]) & (ids[cols] != names[rows, None]))
                    best.merge(rows[r], score[r, c], ids[cols[c]])
        yield best.rows()

    return run


def _negatives(shared, depth: int, scale: int, width: int, count: int):
    """Slots are anchor * width + number of the positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, points, least, most = shared.value
        best = Heaps(len(labels) * width, count)
        for ids, own, vectors in _tiles(batches, depth, scale):
            right = np.ascontiguousarray(vectors.T)
            for low in range(0, len(labels), TILE[0]):
                rows = np.arange(low, min(low + TILE[0], len(labels)))
                score = strassen(points[rows], right)
                score = np.where(own != labels[rows, None], score, _NONE)
                for k in range(width):
                    slot = rows * width + k
                    bound = np.maximum(least[slot], best.worst[slot])
                    r, c = np.nonzero((score >= bound[:, None]) & (score <= most[slot, None]))
                    best.merge(slot[r], score[r, c], ids[c])
        yield best.rows()

    return run


def _merged(rows: DataFrame, count: int) -> DataFrame:
    """The best ``count`` of each slot, with their rank."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def valid_rows(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return df.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("v")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine)
    )


def mine(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 50,
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows whose key is divisible by ``every``. A row's score is the inner product
    of floor(``scale`` * x) with the anchor's; higher scores come first, ties by the smaller key.
    An anchor's positives are its first ``positives`` other rows of its label; for each of them
    the first ``negatives`` rows of another label with
    ``low`` * positive_score <= 100 * negative_score <= ``high`` * positive_score are returned
    (so none where the positive's score is negative).

    Rows with a null key, label, vector, or a null or non-finite component take no part, nor do
    vectors with a component so large that a score might not fit a long (2^27 after scaling, with
    64 components). A shorter vector counts as filled up with zeros. Rows that repeat a key stand
    for themselves: each takes a place, each anchor row has its results, and rows with the anchor's
    own key are never its partners. Other columns are not read; an empty table gives no rows.

    Candidates are never shuffled. Anchors are broadcast in passes of about PASS_BYTES, however
    many there are; a pass reads the candidates twice, and only heaps (a few entries per anchor
    and task) are shuffled and merged.
    """
    spark = vectors.sparkSession
    base = checkpointed(valid_rows(vectors, key, vector, label))
    depth, asked = base.agg(F.max(F.size("v")), F.count(F.when(F.col("id") % every == 0, 1))).first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not asked or not depth:
        return spark.createDataFrame([], schema)
    reach = math.isqrt((1 << 63) // (100 * depth)) - 1
    rows = base.where(F.forall("v", lambda x: F.abs(x.cast("double")) * scale < reach))
    passes = -(-asked * depth * 8 // PASS_BYTES)
    anchors = rows.where(F.col("id") % every == 0).withColumn("pass", F.pmod(F.xxhash64("id", "label", "v"), F.lit(passes)))
    done = [_one_pass(rows, anchors.where(F.col("pass") == k), depth, scale, positives, negatives, low, high) for k in range(passes)]
    found = [x for x in done if x is not None]
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _one_pass(rows: DataFrame, anchors: DataFrame, depth: int, scale: int, positives: int, negatives: int, low: int, high: int) -> DataFrame | None:
    """The result for the anchors of one pass, which the driver holds; stored."""
    context = rows.sparkSession.sparkContext
    table = anchors.select("id", "label", "v").toArrow()
    if not table.num_rows:
        return None
    names, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
    points = integers(table.column("v"), depth, scale)
    shared = context.broadcast((names, labels, points))
    first = _merged(rows.mapInArrow(_positives(shared, depth, scale, positives), _ROWS), positives).toArrow()
    slot = first.column("slot").to_numpy() * positives + first.column("rank").to_numpy() - 1
    score, ids = (np.zeros(len(names) * positives, np.int64) for _ in range(2))
    score[slot], ids[slot] = first.column("score").to_numpy(), first.column("id").to_numpy()
    least, most = np.ones_like(score), np.zeros_like(score)  # nothing lies between one and zero
    least[slot] = -(-low * score[slot] // 100)
    most[slot] = high * score[slot] // 100
    windows = context.broadcast((labels, points, least, most))
    found = _merged(rows.mapInArrow(_negatives(windows, depth, scale, positives, negatives), _ROWS), negatives)
    named = context.broadcast((np.repeat(names, positives), ids, score))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, positive, top = named.value
        for batch in batches:
            at = batch.column("slot").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[at]), pa.array(positive[at]), batch.column("rank"), batch.column("id"), pa.array(top[at]), batch.column("score")],
                names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
            )

    kind = T.StructType([T.StructField(c, T.IntegerType() if c == "rank" else T.LongType()) for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])
    return checkpointed(found.select("slot", "rank", "id", "score").mapInArrow(name, kind))
