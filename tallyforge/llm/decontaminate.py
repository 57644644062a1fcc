"""Benchmark decontamination: which words of a document lie in windows of benchmark items.

Wu-Manber search over words. For each window length one table of shifts, indexed by the hash of
a block of words, says how far the search may jump; where it may not jump, the hash of that
block - the window's suffix - picks a bucket of test windows. Those of the bucket whose first
block has the hash of the block at the window's start are compared word by word. All texts of a
piece are searched in step: every cursor (one per stretch of a text) jumps by its own shift.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pyspark.sql.types as T
from pyspark.sql import DataFrame

from tallyforge.session import checkpointed

from .textops import ALNUM, Words, free_name, pieces, windows_hash

WINDOW = 13
#: At most so much benchmark text is in an executor's memory; a larger set takes more passes.
PASS_BYTES = 8 << 20
_STRETCH = 512


@dataclass
class _Length:
    """Search tables of the test windows of one length, in words."""

    size: int
    block: int
    shift: np.ndarray
    suffixes: np.ndarray  # hashes of last blocks, ascending: the buckets
    first: np.ndarray  # of each bucket in the three lists below
    prefixes: np.ndarray  # hashes of first blocks, ascending in each bucket
    texts: list[bytes] = field(default_factory=list)
    items: list[list[int]] = field(default_factory=list)


class Patterns:
    """Windows of benchmark items, ready to be searched for."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        by_size: dict[int, dict[bytes, set[int]]] = {}
        for number, (_, text) in enumerate(items):
            raw = np.frombuffer(text.encode(), np.uint8)
            words = Words(raw, np.array([0, len(raw)]), ALNUM)
            n = len(words.start)
            size = min(n, window)
            for a in range(n - size + 1 if n else 0):
                by_size.setdefault(size, {}).setdefault(words.text(a, a + size), set()).add(number)
        self.lengths = [self._tables(size, found) for size, found in sorted(by_size.items())]

    @staticmethod
    def _tables(size: int, found: dict[bytes, set[int]]) -> _Length:
        block = min(3, size)
        texts = list(found)
        blocks = []
        for text in texts:
            raw = np.frombuffer(text, np.uint8)
            own = Words(raw, np.array([0, len(raw)]), ALNUM).hashes()
            blocks.append(windows_hash(own, block))
        bits = max(10, int(np.ceil(np.log2(len(texts) * size * 8))))
        shift = np.full(1 << bits, size - block + 1, np.int64)
        for own in blocks:
            where = (own >> np.uint64(64 - bits)).astype(np.int64)
            np.minimum.at(shift, where, size - block - np.arange(len(own)))
        ends = np.array([own[-1] for own in blocks], np.uint64)
        heads = np.array([own[0] for own in blocks], np.uint64)
        order = np.lexsort((heads, ends))
        unique, first = np.unique(ends[order], return_index=True)
        return _Length(
            size, block, shift, unique, np.append(first, len(order)), heads[order],
            [texts[i] for i in order], [sorted(found[texts[i]]) for i in order],
        )

    def search(self, words: Words) -> Iterator[tuple[int, int, list[int]]]:
        """(first word, number of words, item numbers) of each occurrence."""
        if not self.lengths or not len(words.start):
            return
        hashes = words.hashes()
        for table in self.lengths:
            block = windows_hash(hashes, table.block)
            places, buckets = self._candidates(table, block, words.row)
            for place, bucket in zip(places.tolist(), buckets.tolist()):
                low, high = table.first[bucket], table.first[bucket + 1]
                k = low + int(np.searchsorted(table.prefixes[low:high], block[place]))
                if k == high or table.prefixes[k] != block[place]:
                    continue
                text = words.text(place, place + table.size)
                while k < high and table.prefixes[k] == block[place]:
                    if table.texts[k] == text:
                        yield place, table.size, table.items[k]
                    k += 1

    @staticmethod
    def _candidates(table: _Length, block: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose window ends in the block of a bucket, and which bucket."""
        none = np.zeros(0, np.int64)
        bits = np.uint64(65 - len(table.shift).bit_length())
        jump = table.shift[(block >> bits).astype(np.int64)]
        reach = table.size - table.block  # from a window's start to its last block
        starts, ends = [], []
        for a, b in zip(row[:-1], row[1:]):
            last = b - table.size  # the last place where a window can start
            if last >= a:
                own = np.arange(a, last + 1, _STRETCH)
                starts.append(own)
                ends.append(np.minimum(own + _STRETCH, last + 1))
        if not starts:
            return none, none
        at, end = np.concatenate(starts), np.concatenate(ends)
        hits = []
        while len(at):
            step = jump[at + reach]
            stop = at[step == 0]
            if len(stop):
                hits.append(stop)
            at = at + np.maximum(step, 1)
            keep = at < end
            at, end = at[keep], end[keep]
        if not hits:
            return none, none
        places = np.sort(np.concatenate(hits))
        ends = block[places + reach]
        slot = np.minimum(np.searchsorted(table.suffixes, ends), len(table.suffixes) - 1)
        met = table.suffixes[slot] == ends
        return places[met], slot[met]


def _searcher(shared, keep: list[str], names: list[str], text: str, tf: list[str], last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = shared.value
        for batch in batches:
            old_hits = batch.column(tf[0]).to_pylist()
            old_items = batch.column(tf[1]).to_pylist()
            hits, items, total = [], [], []
            for first, end, raw, at in pieces(batch.column(text)):
                words = Words(raw, at, ALNUM)
                marked = np.zeros(len(words.start), bool)
                found: dict[int, set[int]] = {}
                for place, size, numbers in patterns.search(words):
                    marked[place : place + size] = True
                    found.setdefault(int(np.searchsorted(words.row, place, "right")) - 1, set()).update(numbers)
                for k in range(end - first):
                    own = marked[words.row[k] : words.row[k + 1]]
                    before, hold = old_hits[first + k], set(old_items[first + k] or ())
                    if before:
                        own = own | np.unpackbits(np.frombuffer(before, np.uint8), count=len(own)).astype(bool)
                    hold |= {patterns.names[i] for i in found.get(k, ())}
                    hits.append(np.packbits(own).tobytes() if own.any() else None)
                    items.append(sorted(hold))
                    total.append(len(own))
            columns = [batch.column(c) for c in keep]
            if last:
                n_hit = [int(np.unpackbits(np.frombuffer(h, np.uint8)).sum()) if h else 0 for h in hits]
                columns += [
                    pa.array(total, pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                    pa.array(items, pa.list_(pa.string())),
                ]
            else:
                columns += [pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(total, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = 20,
    prefix: str = "",
) -> DataFrame:
    """The columns ``keep`` (default all) of every row of ``docs``, and the new columns n_words,
    n_hit, n_items, items_sha256, items and contaminated (``share`` * hits >= words), their names
    led by ``prefix``.

    A null or empty text has no words and is clean. Items with null or empty texts, or without an
    id, never match; the same words under two items count for both. An empty benchmark leaves all
    clean. Repeated rows are each judged. A kept column with the name of a new one is an error;
    choose a ``prefix``.

    No shuffle: documents pass through one map. The benchmark is cut into passes of PASS_BYTES
    of text (one pass for a usual set), each a broadcast of bounded size; between passes the
    documents are checkpointed.
    """
    keep = docs.columns if keep is None else keep
    new = [prefix + c for c in ("n_words", "n_hit", "n_items", "items_sha256", "items", "contaminated")]
    if clash := set(keep) & set(new):
        raise ValueError(f"columns {sorted(clash)} are there already: give a prefix")
    spark = docs.sparkSession
    own, *tf = (free_name(c, keep) for c in ("tf_text", "tf_hits", "tf_items", "tf_words"))
    base = docs.select(*keep, F.col(text).alias(own)).withColumns(
        {tf[0]: F.lit(None).cast("binary"), tf[1]: F.lit(None).cast("array<string>"), tf[2]: F.lit(0).cast("bigint")}
    )
    passes = _passes(benchmark, item_id, item_text)
    work = next(passes, [])
    while True:
        after = next(passes, None)
        kept = list(keep) if after is None else [*keep, own]
        fields = [base.schema[c] for c in kept]
        if after is None:
            fields += [T.StructField(n, t) for n, t in zip(new[:5], [T.LongType()] * 3 + [T.StringType(), T.ArrayType(T.StringType())])]
        else:
            fields += [base.schema[c] for c in tf]
        schema = T.StructType(fields)
        shared = spark.sparkContext.broadcast(Patterns(work, window))
        base = base.mapInArrow(_searcher(shared, kept, schema.names, own, tf, after is None), schema)
        if after is None:
            hit, total = F.col(new[1]), F.col(new[0])
            return base.withColumn(new[5], (hit > 0) & (hit * share >= total))
        base, work = checkpointed(base), after


def _passes(benchmark: DataFrame, item_id: str, item_text: str) -> Iterator[list[tuple[str, str]]]:
    """The items in runs of up to PASS_BYTES, one fetched at a time."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null")
    run, size = [], 0
    for row in rows.toLocalIterator():
        if run and size + len(row.t) > PASS_BYTES:
            yield run
            run, size = [], 0
        run.append((row.i, row.t))
        size += len(row.t)
    yield run
