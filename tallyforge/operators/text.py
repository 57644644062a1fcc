"""Word counts over whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from heapq import nsmallest

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import words_of
from ..session import checkpointed
from .joins import lookup_join


def split_words(df: DataFrame, text: str) -> DataFrame:
    """One row per non-empty word of the text column, in a column ``word``."""
    return df.select(F.explode(words_of(text)).alias("word")).filter(F.col("word") != "")


def word_counts(df: DataFrame, text: str, stop: DataFrame | Iterable[str] | None = None) -> DataFrame:
    """(word, count). ``stop`` is a table with a column ``word``, or a few words.

    A stop table is excluded after counting, when each word is one row: the shuffle
    of the counts is small either way, and the table is then looked up once per
    distinct word instead of once per occurrence.
    """
    words = split_words(df, text)
    if stop is not None and not isinstance(stop, DataFrame):
        words = words.filter(~F.col("word").isin(*stop))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    if isinstance(stop, DataFrame):
        counts = lookup_join(counts, stop.select("word"), "word", "left_anti", skewed=False)
    return counts


def top_words(
    df: DataFrame, text: str, stop: DataFrame | Iterable[str] | None = None, n: int = 10
) -> DataFrame:
    """The ``n`` most frequent words; equal counts in alphabetical order."""
    return word_counts(df, text, stop).orderBy(F.desc("count"), "word").limit(n)


#: Different words that a task counts before it begins a new list.
LIST_WORDS = 500_000


def _lists(words: DataFrame, n: int) -> DataFrame:
    """word, count and whether the word is among the first n of its local list: the counts of the
    words of a task, or of a part of them once there are LIST_WORDS different ones. Each task
    adds a row with a null word that says how many lists it had."""
    limit = LIST_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        lists = 0
        for batch in batches:
            found = pc.value_counts(batch.column("word"))
            for word, k in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
                counts[word] += k
            if len(counts) >= limit:
                yield _listed(counts)
                counts, lists = Counter(), lists + 1
        yield _listed(counts)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([lists + 1], pa.int64()), pa.array([True])], names=["word", "count", "first"])

    def _listed(counts: Counter[str]) -> pa.RecordBatch:
        top = {w for w, _ in nsmallest(n, counts.items(), key=lambda x: (-x[1], x[0]))}
        first = pa.array([w in top for w in counts], pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64()), first], names=["word", "count", "first"])

    return words.mapInArrow(run, "word string, count bigint, first boolean")


def _candidates(lists: DataFrame, n: int) -> DataFrame:
    """The words of stored lists that :func:`word_candidates` lets through."""
    sums = lists.where("first").groupBy("word").agg(F.sum("count").alias("count"))
    top = sums.orderBy(F.col("word").isNotNull(), F.desc("count")).limit(n + 1).collect()
    number = max(1, top[0]["count"]) if top else 1
    threshold = top[n]["count"] if len(top) > n else 1
    least = -(-threshold // number)
    return lists.where(F.col("word").isNotNull() & (F.col("count") >= least)).select("word").distinct()


def word_candidates(words: DataFrame, n: int) -> DataFrame:
    """The only words that can be among the ``n`` most frequent (column ``word``).

    Words are counted locally, once. Sums over the lists' own first n are lower bounds of
    counts; the n-th largest of them is the threshold t. A word with t occurrences or more has
    at least t / m of them in one of the m lists, so words with fewer in each list are out.
    """
    return _candidates(checkpointed(_lists(words, n)), n)


def top_words_threshold(df: DataFrame, text: str, stop: DataFrame | Iterable[str] | None = None, n: int = 10) -> DataFrame:
    """The same as :func:`top_words` without shuffling the counts of all words: the local lists
    are stored, and only the candidates' counts in them are shuffled and added up. The texts are
    read once; the lists take as much disk as their different words."""
    words = split_words(df, text)
    if isinstance(stop, DataFrame):
        words = lookup_join(words, stop.select("word"), "word", "left_anti", skewed=False)
    elif stop is not None:
        words = words.filter(~F.col("word").isin(*stop))
    lists = checkpointed(_lists(words, n))
    candidates = checkpointed(_candidates(lists, n))
    exact = lookup_join(lists, candidates, "word", "left_semi", skewed=False).groupBy("word").agg(F.sum("count").alias("count"))
    return exact.orderBy(F.desc("count"), "word").limit(n)
