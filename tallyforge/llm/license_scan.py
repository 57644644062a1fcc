"""Licence texts in documents, by diagonal voting.

All rolling word grams of the documents are joined to the places of the same grams in the
templates. A pair of places lies on the diagonal document place - template place; a stretch of
a document that copies a template puts its votes on one diagonal, or on neighbouring ones where
words were added or left out. Votes are added up by diagonal, neighbouring diagonals are merged
to spans, and a span counts once its words have been compared with the template's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pyspark.sql.types as T
from pyspark.sql import DataFrame, SparkSession, Window

from tallyforge.session import checkpointed

from .textops import ALNUM, Words, free_name, pieces, windows_hash

#: Words of a gram; a shorter template is one gram.
GRAM = 4
#: Words that may be added or left out between two diagonals of one span.
DRIFT = 12
#: A template of fewer words counts only if it stands there whole, a longer one if SHARE of its
#: words do, in order, and VOTES of its grams.
EXACT_BELOW = 16
SHARE = 0.8
VOTES = 0.25
BROADCAST_ROWS = 500_000
#: Texts a task remembers, to send copies once.
SEEN = 200_000


def _words(text: str) -> list[bytes]:
    raw = np.frombuffer(text.encode(), np.uint8)
    words = Words(raw, np.array([0, len(raw)]), ALNUM)
    return [words.data[a:b].tobytes() for a, b in zip(words.start, words.end)]


class Templates:
    """Texts with their labels; ``whole[n]`` says that template n is a phrase to be counted."""

    def __init__(self, phrases: list[tuple[str, str]], texts: list[tuple[str, str]]):
        both = [(x, label, True) for x, label in phrases] + [(x, label, False) for x, label in texts]
        both = [(words, label, base) for x, label, base in both if (words := _words(x))]
        self.words = [w for w, _, _ in both]
        self.label = [label for _, label, _ in both]
        self.base = [base for _, _, base in both]

    def gram(self, n: int) -> int:
        return min(GRAM, len(self.words[n]))

    @property
    def sizes(self) -> list[int]:
        return sorted({self.gram(n) for n in range(len(self.words))})

    def exact(self, n: int) -> bool:
        return self.base[n] or len(self.words[n]) < EXACT_BELOW

    def rows(self) -> Iterator[tuple[int, int, int]]:
        """(gram hash, template, place in the template)."""
        for n, words in enumerate(self.words):
            raw = np.frombuffer(b" ".join(words), np.uint8)
            hashes = Words(raw, np.array([0, len(raw)]), ALNUM).hashes()
            for place, gram in enumerate(windows_hash(hashes, self.gram(n)).view(np.int64).tolist()):
                yield gram, n, place

    def table(self, spark: SparkSession) -> DataFrame:
        found = list(self.rows())
        rows = spark.createDataFrame(found, "same bigint, template int, template_place int")
        return F.broadcast(rows) if len(found) <= BROADCAST_ROWS else rows

    def coverage(self, n: int, words: list[bytes]) -> float:
        """The share of the template's words that stand in ``words`` in order (their longest
        common subsequence, on the bits of one integer)."""
        own = self.words[n]
        where: dict[bytes, int] = {}
        for k, word in enumerate(own):
            where[word] = where.get(word, 0) | 1 << k
        full = (1 << len(own)) - 1
        left = full
        for word in words:
            met = left & where.get(word, 0)
            left = ((left + met) | (left - met)) & full
        return (len(own) - left.bit_count()) / len(own)


def _grams(sizes: list[int]):
    """copy (the text's hash), place and gram of all rolling grams; copies of a text that a task
    has met add nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            names = batch.column("copy").to_numpy()
            fresh = np.zeros(len(names), bool)
            for k, name in enumerate(names.tolist()):
                if name not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(name)
                    fresh[k] = True
            batch = batch.filter(pa.array(fresh))
            names = names[fresh]
            for first, end, raw, at in pieces(batch.column("text")):
                words = Words(raw, at, ALNUM)
                hashes, row = words.hashes(), words.row
                own = np.repeat(np.arange(end - first), np.diff(row))
                for size in sizes:
                    gram = windows_hash(hashes, size)
                    inside = np.flatnonzero(own[: len(gram)] == own[size - 1 :]) if len(gram) else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[first:end][own[inside]]), pa.array((inside - row[own[inside]]).astype(np.int32)), pa.array(gram[inside].view(np.int64))],
                        names=["copy", "place", "gram"],
                    )

    return run


def spans(docs: DataFrame, templates: Templates) -> DataFrame:
    """copy, template, low (the place where the template would begin) and slack: the candidate
    spans of each text. ``docs`` has copy, the text's hash, and text."""
    spark = docs.sparkSession
    rows = docs.mapInArrow(_grams(templates.sizes), "copy bigint, place int, gram bigint")
    hits = rows.join(templates.table(spark), F.col("gram") == F.col("same")).select("copy", "template", "place", (F.col("place") - F.col("template_place")).alias("diagonal"))
    # Copies of a text in several tasks vote once.
    votes = hits.distinct().groupBy("copy", "template", "diagonal").agg(F.count("*").alias("votes"), F.min("place").alias("from"), F.max("place").alias("to"))
    known = spark.createDataFrame(
        [(n, templates.exact(n), len(w) - templates.gram(n) + 1, len(w)) for n, w in enumerate(templates.words)], "template int, exact boolean, grams int, n int"
    )
    votes = votes.join(F.broadcast(known) if len(templates.words) <= BROADCAST_ROWS else known, "template")
    whole = votes.where("exact and votes = grams").select("copy", "template", F.col("diagonal").alias("low"), F.lit(0).alias("slack"))
    order = Window.partitionBy("copy", "template").orderBy("from", "diagonal")
    before = lambda c: F.lag(c).over(order)
    apart = before("diagonal").isNull() | (F.abs(F.col("diagonal") - before("diagonal")) > DRIFT) | (F.col("from") - before("to") > F.col("n"))
    loose = votes.where("not exact").withColumn("opens", F.when(apart, 1).otherwise(0)).withColumn("span", F.sum("opens").over(order))
    merged = loose.groupBy("copy", "template", "span").agg(
        F.sum("votes").alias("votes"), F.first("grams").alias("grams"), F.min("diagonal").alias("low"), (F.max("diagonal") - F.min("diagonal")).alias("slack")
    )
    merged = merged.where(F.col("votes") >= F.lit(VOTES) * F.col("grams")).select("copy", "template", "low", "slack")
    return whole.union(merged)


def scan(
    docs: DataFrame, phrases: list[tuple[str, str]], texts: list[tuple[str, str]] = (), text: str = "text", keep: list[str] | None = None, prefix: str = "",
) -> DataFrame:
    """The columns ``keep`` (default all) and n_words, n_base, first_word, last_word, base_labels,
    labels, score and found, their names led by ``prefix``, of every whole text.

    ``phrases`` (phrase, label) are found where their words stand one after another; n_base
    counts all places, first_word and last_word are the smallest and the largest (words from 0,
    else null). ``texts`` (text, label) are licence texts and notices: a short one must stand
    there whole, a longer one with SHARE of its words. ``found`` has label, first word, number of
    words and share of the template for every place, ascending. labels are those of both, distinct,
    sorted and joined by commas; score is the largest share, 0 without any. Words are digits,
    letters and all beyond ASCII, A-Z lower-cased.

    Null and empty texts have no words. Rows are judged one by one, copies too; the same words
    under two labels count for both. No templates: nothing is found. A kept column with the name
    of a new one is an error.

    Grams meet the templates in a broadcast join (up to BROADCAST_ROWS template grams, else a
    shuffled one), so only those that a template holds are shuffled. Texts are shuffled only
    where the texts with a span are more than BROADCAST_ROWS.
    """
    keep = docs.columns if keep is None else keep
    new = [prefix + c for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found")]
    if clash := set(keep) & set(new):
        raise ValueError(f"columns {sorted(clash)} are there already: give a prefix")
    spark, templates = docs.sparkSession, Templates(list(phrases), list(texts))
    copy = F.xxhash64(F.col(text))
    candidates = spans(docs.where(F.col(text).isNotNull()).select(copy.alias("copy"), F.col(text).alias("text")), templates)
    own, same, asked = (free_name(c, keep) for c in ("tf_text", "tf_same", "tf_spans"))
    gathered = checkpointed(candidates.groupBy(F.col("copy").alias(same)).agg(F.collect_list(F.struct("template", "low", "slack")).alias(asked)))
    few = gathered.agg(F.coalesce(F.sum(F.size(asked) + 1), F.lit(0))).first()[0] <= BROADCAST_ROWS
    joined = docs.select(*keep, F.col(text).alias(own)).join(F.broadcast(gathered) if few else gathered, F.xxhash64(own) == F.col(same), "left")
    place = T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("share", T.DoubleType())])
    kinds = [T.LongType()] * 4 + [T.StringType()] * 2 + [T.DoubleType(), T.ArrayType(place)]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, kind) for c, kind in zip(new, kinds)])
    names, shared = schema.names, spark.sparkContext.broadcast(templates)
    arrow = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("n_words", pa.int64()), ("share", pa.float64())]))]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = shared.value
        for batch in batches:
            wanted, out = batch.column(asked), []
            for first, end, raw, at in pieces(batch.column(own)):
                words = Words(raw, at, ALNUM)
                for k in range(first, end):
                    low, high = words.row[k - first], words.row[k - first + 1]
                    out.append(_judged(templates, words, int(low), int(high), wanted[k].as_py() or ()))
            columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), *columns], names=names)

    return joined.mapInArrow(judge, schema)


def _judged(templates: Templates, words: Words, low: int, high: int, spans) -> tuple:
    places, found, base = [], [], set()
    for span in spans:
        n = span["template"]
        size, at = len(templates.words[n]), low + span["low"]
        if templates.exact(n):
            first, end = at, at + size
            whole = low <= first and end <= high and words.text(first, end) == b" ".join(templates.words[n])
            share = 1.0 if whole else 0.0
        else:
            first, end = max(low, at), min(high, at + size + span["slack"] + DRIFT)
            share = templates.coverage(n, words.text(first, end).split(b" "))
        if share < SHARE:
            continue
        found.append({"label": templates.label[n], "first": first - low, "n_words": end - first, "share": share})
        if templates.base[n]:
            places.append(first - low)
            base.add(templates.label[n])
    found.sort(key=lambda f: (f["first"], f["label"]))
    labels = sorted({f["label"] for f in found})
    ends = (min(places), max(places)) if places else (None, None)
    return high - low, len(places), *ends, ",".join(sorted(base)), ",".join(labels), max((f["share"] for f in found), default=0.0), found
