"""Token counts without ids: merging over a heap and a linked list.

The heap holds (rank, position) of mergeable neighbours; the list says who a symbol's live
neighbours are. Entries that a merge has made stale are dropped when they come up. A text's
count is its bytes less its merges, plus one for each special string in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
import pyspark.sql.types as T
import regex
from pyspark.sql import DataFrame

from .textops import free_name
from .vocab import PIECES, PieceCache, merge_file, read_file


class MergeCounter:
    def __init__(self, data: bytes):
        self.byte_ids, self.merges, special = merge_file(data)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.cache = PieceCache(lambda pieces: [self.count(p.encode()) for p in pieces])

    def count(self, piece: bytes) -> int:
        """Symbols left of one piece: bytes less merges."""
        merges, n = self.merges, len(piece)
        symbol = [self.byte_ids[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for k in range(n - 1):
            if (merge := merges.get((symbol[k], symbol[k + 1]))) is not None:
                heap.append((merge[0], k, merge[1]))
        heapify(heap)
        left = n
        while heap:
            _, at, merged = heappop(heap)
            gone = after[at]
            if symbol[at] < 0 or gone >= n:
                continue
            found = merges.get((symbol[at], symbol[gone]))
            if found is None or found[1] != merged:
                continue
            left -= 1
            symbol[at], symbol[gone] = merged, -1
            follow = after[at] = after[gone]
            if follow < n:
                before[follow] = at
                if (merge := merges.get((merged, symbol[follow]))) is not None:
                    heappush(heap, (merge[0], at, merge[1]))
            ahead = before[at]
            if ahead >= 0 and (merge := merges.get((symbol[ahead], merged))) is not None:
                heappush(heap, (merge[0], ahead, merge[1]))
        return left

    def text(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(sum(self.cache.values(PIECES.findall(p))) for p in parts if p)


@lru_cache(maxsize=2)
def _counter(data: bytes) -> MergeCounter:
    return MergeCounter(data)


def token_counts(
    docs: DataFrame,
    path: str,
    text: str = "text",
    keep: list[str] | None = None,
    limit: int = 512,
    prefix: str = "",
) -> DataFrame:
    """The columns ``keep`` (default all) with n_bytes, n_tokens and over_limit
    (n_tokens > ``limit``), their names led by ``prefix``, of every whole text.

    Null and empty texts have 0 of both. Special strings inside a text count as one token each.
    A long piece costs O(n log n). Each row stands for itself, repeated or not. One map, no
    shuffle; the vocabulary (a few megabytes) is broadcast. A kept column with the name of a
    new one is an error.
    """
    keep = docs.columns if keep is None else keep
    new = [prefix + c for c in ("n_bytes", "n_tokens", "over_limit")]
    if clash := set(keep) & set(new):
        raise ValueError(f"columns {sorted(clash)} are there already: give a prefix")
    shared = docs.sparkSession.sparkContext.broadcast(read_file(path))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in new[:2]])
    names, own = schema.names, free_name("tf_text", keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            texts = batch.column(own)
            sizes = pc.coalesce(pc.binary_length(texts).cast(pa.int64()), pa.scalar(0, pa.int64()))
            counts = pa.array([counter.text(x.as_py() or "") for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), sizes, counts], names=names)

    counted = docs.select(*keep, F.col(text).alias(own)).mapInArrow(run, schema)
    return counted.withColumn(new[2], F.col(new[1]) > limit)
