"""Sums of products of all pairs of many columns, from one scan.

Each task multiplies blocks of rows as matrices and keeps, for each group, one set of sums of
values less a shift of its own (the first value that it met of each column, so that values far
from zero lose no digits). Two sets are brought to one shift and added. They are merged by a
tree, so no task holds more than a few hundred of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

#: Sets of sums that one task merges, about.
BRANCH = 256


@dataclass
class Moments:
    """Over the rows where both a and b are present: ``n[a, b]`` their number, ``s[a, b]`` the sum
    of a, ``q[a, b]`` that of a squared and ``p[a, b]`` that of a times b, all less ``shift``."""

    shift: np.ndarray
    n: np.ndarray
    s: np.ndarray
    q: np.ndarray
    p: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        """Of a matrix with NaN for what is missing."""
        there = ~np.isnan(rows)
        first = np.where(there.any(axis=0), there.argmax(axis=0), 0)
        shift = np.where(there.any(axis=0), rows[first, np.arange(rows.shape[1])] if len(rows) else 0.0, 0.0)
        with np.errstate(invalid="ignore", over="ignore"):
            x = np.where(there, rows - shift, 0.0)
            mask = there.astype(np.float64)
            return cls(shift, mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x)

    def moved(self, shift: np.ndarray) -> Moments:
        """The same less another shift."""
        d = (self.shift - shift)[:, None]
        with np.errstate(invalid="ignore", over="ignore"):
            return Moments(
                shift, self.n, self.s + d * self.n, self.q + 2 * d * self.s + d * d * self.n,
                self.p + d * self.s.T + d.T * self.s + d * d.T * self.n,
            )

    def __add__(self, other: Moments) -> Moments:
        # A column without values here has no shift of its own.
        shift = np.where(np.diag(self.n) > 0, self.shift, other.shift)
        a, b = self.moved(shift), other.moved(shift)
        return Moments(shift, a.n + b.n, a.s + b.s, a.q + b.q, a.p + b.p)

    def to_bytes(self) -> bytes:
        return np.concatenate([self.shift[None], self.n, self.s, self.q, self.p]).astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, width: int) -> Moments:
        rows = np.frombuffer(data, "<f8").reshape(-1, width)
        return cls(rows[0], *np.split(rows[1:], 4))

    def correlations(self) -> np.ndarray:
        """Of all pairs, NaN where one of the two is constant or there are fewer than two rows."""
        with np.errstate(invalid="ignore", divide="ignore"):
            n = np.where(self.n > 1, self.n, np.nan)
            over = self.p - self.s * self.s.T / n
            spread = self.q - self.s**2 / n
            spread = np.where(spread > 1e-14 * self.q, spread, 0.0)  # what rounding leaves of none
            found = over / np.sqrt(spread * spread.T)
            return np.where((spread > 0) & (spread.T > 0), np.clip(found, -1, 1), np.nan)


def moments(df: DataFrame, cols: Sequence[str], group: str | None = None, whole_rows: bool = False) -> dict[object, Moments]:
    """The moments of numeric columns for each value of ``group`` (a few values, as an integer;
    null is a group of its own; without it there is one, None). Nulls are missing, pair by pair,
    or with ``whole_rows`` a row with any null does not count; NaN counts as missing too. The
    driver gets four matrices of columns by columns per group."""
    cols, width = list(cols), len(cols)
    values = df.select(*([F.col(group).cast("bigint").alias("g")] if group else [F.lit(0).cast("bigint").alias("g")]), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int | None, Moments] = {}
        for batch in batches:
            rows = np.stack([batch.column(i + 1).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(width)], axis=1)
            groups = batch.column(0).to_pandas(integer_object_nulls=True).to_numpy()
            if whole_rows:
                fine = ~np.isnan(rows).any(axis=1)
                rows, groups = rows[fine], groups[fine]
            codes, names = pd.factorize(groups, use_na_sentinel=False)
            for code, g in enumerate(names.tolist()):
                part = Moments.of(rows[codes == code])
                g = None if g is None or g != g else int(g)
                found[g] = found[g] + part if g in found else part
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array([part] * len(found), pa.int32()), pa.array([m.to_bytes() for m in found.values()], pa.binary())],
            names=["g", "part", "sums"],
        )

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total = None
        for data in frame.sort_values("part")["sums"]:
            one = Moments.from_bytes(data, width)
            total = one if total is None else total + one
        return pd.DataFrame({"g": frame["g"].iloc[:1].to_numpy(), "part": [int(frame["part"].iloc[0]) // BRANCH], "sums": [total.to_bytes()]})

    kind = "g bigint, part int, sums binary"
    level = values.mapInArrow(add, kind)
    for _ in range(2):  # BRANCH squared tasks
        level = level.groupBy("g", F.floor(F.col("part") / BRANCH).alias("branch")).applyInPandas(merge, kind)
    out: dict[object, Moments] = {}
    for row in level.orderBy("part").collect():
        one, g = Moments.from_bytes(bytes(row["sums"]), width), row["g"] if group else None
        out[g] = out[g] + one if g in out else one
    return out
