"""Documents linked by the Jaccard similarity of their word shingles: a parity-sketch join.

A set's sketch has blocks; each shingle is XORed into one of them. The sketches of two sets
differ in no more blocks than the sets in shingles. A similarity of at least t bounds that
difference by (1 - t) / (1 + t) of both sizes together, so of one block more than the bound at
least one is equal in both sketches (pigeonhole): documents of neighbouring sizes are joined on
equal blocks. Short sketches of single parity bits, whose Hamming distance is a lower bound of
the difference too, then drop most candidates, and the shingles of the rest are compared. No
link is lost on the way, whatever the sizes.

Similar sets agree in far more than one block, as the bound is met only by the largest sets of a
band. Of its blocks that others share, a set may so leave out the most frequent ones, by one
fewer than it must share with any similar set: in one order of all blocks, the first that two
similar sets share stays in both (a prefix filter). Wording that many unlike documents share
then brings few of them together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import DataFrame, Window

from tallyforge.session import arrow_rows, checkpointed

from .components import more_components
from .textops import SPACED, Words, mix, pieces, windows_hash

#: Sizes of a band lie within this factor; a set near the upper end also joins the next bands.
BAND = 1.25
#: A block with fewer shingles says little. Each band has some blocks to spare, so that similar
#: sets agree in more blocks than are weak, and weak ones need not be joined on; only a set with
#: more weak blocks than that joins on them too.
WEAK = 2
#: Bits of the short sketch, per shingle, and at least.
SHORT_BITS = 2
SHORT_LEAST = 64
#: 64-bit words of the sketch that travels with the members of an unsettled bucket; of one
#: length for all sets, so that any two compare.
WORDS = 8
#: Narrow rows that are broadcast at most.
BROADCAST_ROWS = 500_000
#: Rows of an Arrow batch, which holds whole texts, or two of them.
BATCH_ROWS = 1000
#: The last bits of a bucket are the number of its band, as far as they go.
BAND_BITS = 7
#: Further members that all members of an unsettled bucket are compared with.
PIVOTS = 3


class Plan:
    """Numbers that follow from the similarity, given as a fraction above / below."""

    def __init__(self, above: int, below: int, shingle: int):
        self.above, self.below, self.shingle = above, below, shingle

    def difference(self, total: int) -> int:
        """The most shingles that two similar sets of ``total`` shingles together differ in."""
        return total * (self.below - self.above) // (self.below + self.above)

    def bands(self, size: int) -> list[int]:
        """Upper ends of the bands that a set joins: its own, and the next ones if a similar
        set may lie there."""
        found = [self.upper(size)]
        while (found[-1] + 1) * self.above <= size * self.below:
            found.append(self.upper(found[-1] + 1))
        return found

    @staticmethod
    def upper(size: int) -> int:
        return Plan._ends(size)[-1]

    @staticmethod
    def _ends(size: int) -> list[int]:
        """Upper ends of all bands up to that of a set of ``size``."""
        ends = [1]
        while ends[-1] < size:
            ends.append(max(ends[-1] + 1, int(ends[-1] * BAND)))
        return ends

    @staticmethod
    def number(high: int) -> int:
        """The number of a band, as in the last bits of its buckets."""
        return (len(Plan._ends(high)) - 1) % (1 << BAND_BITS)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Join keys of a set: a hash of band, block number and the XOR of the block's shingles."""
        return np.concatenate([self._blocks(shingles, high) for high in self.bands(len(shingles))])

    def spare(self, high: int) -> int:
        """Blocks beyond the pigeonhole number: as many as are weak in most sets of the band."""
        count = self.difference(2 * high) + 1
        if count == 1:
            return 0
        mean = high / BAND * self.above / self.below / count
        weak = count * math.exp(-mean) * sum(mean**k / math.factorial(k) for k in range(WEAK))
        return math.ceil(weak + 2 * math.sqrt(weak))

    def needs(self, shingles: np.ndarray) -> list[tuple[int, int]]:
        """For each band of a set its number, and how many of the set's keys there any similar
        set of the band has too, at least: the blocks that do not differ, without weak ones
        that are not joined on (by this set, or by the other)."""
        size, found = len(shingles), []
        for high in self.bands(size):
            spare, count, _, block = self._placed(shingles, high)
            largest = min(high, size * self.below // self.above)
            weak = int((np.bincount(block, minlength=count) < WEAK).sum())
            found.append((self.number(high), count - self.difference(size + largest) - min(weak, spare)))
        return found

    def _placed(self, shingles: np.ndarray, high: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """Spare blocks and all blocks of a band, and the values and blocks of the shingles."""
        spare = self.spare(high)
        count = self.difference(2 * high) + 1 + spare
        value = mix(shingles + np.uint64(1))
        return spare, count, value, ((value >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)

    def _blocks(self, shingles: np.ndarray, high: int) -> np.ndarray:
        spare, count, value, block = self._placed(shingles, high)
        sketch = np.arange(count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(high)
        sketch = mix(sketch)
        np.bitwise_xor.at(sketch, block, mix(value))
        sketch = sketch & ~np.uint64((1 << BAND_BITS) - 1) | np.uint64(self.number(high))
        if count == 1:
            return sketch
        weak = np.bincount(block, minlength=count) < WEAK
        return sketch[~weak] if weak.sum() <= spare else sketch


def short_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bits of a set, as 64-bit words; more of them for larger sets, by powers of two,
    so that the longer of two sketches folds to the shorter."""
    bits = SHORT_LEAST
    while bits < SHORT_BITS * len(shingles):
        bits *= 2
    flips = np.bincount((mix(shingles) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def fixed_sketch(shingles: np.ndarray) -> np.ndarray:
    """WORDS words of parity bits, whatever the size of the set."""
    flips = np.bincount((mix(shingles) % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Halved by XOR until it has ``words`` words: the sketch with fewer bits of the same set."""
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of each text, ascending. A text of fewer words is one shingle,
    one without words has none."""
    for _, _, raw, at in pieces(column):
        words = Words(raw, at, SPACED)
        hashes = words.hashes()
        for a, b in zip(words.row[:-1], words.row[1:]):
            if b - a >= size:
                yield np.unique(windows_hash(hashes[a:b], size))
            elif b > a:
                yield windows_hash(hashes[a:b], int(b - a))
            else:
                yield np.zeros(0, np.uint64)


def _set_id(shingles: np.ndarray) -> int:
    """64 bits that stand for the whole set."""
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


_FIXED = [f"s{k}" for k in range(WORDS)]


def _profiles(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, sizes, sketches, fixed, needs = [], [], [], [], []
            for shingles in shingle_sets(batch.column("text"), plan.shingle):
                sets.append(_set_id(shingles) if len(shingles) else None)
                sizes.append(len(shingles))
                sketches.append(short_sketch(shingles).tobytes() if len(shingles) else None)
                fixed.append(fixed_sketch(shingles))
                needs.append(plan.needs(shingles) if len(shingles) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("copy"), pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()), *[pa.array([f[k] for f in fixed], pa.int64()) for k in range(WORDS)], pa.array(needs, pa.map_(pa.int32(), pa.int64()))],
                names=["key", "copy", "set", "size", "sketch", *_FIXED, "needs"],
            )

    return run


def _keyed(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, None] = {}  # copies met again in the same task add nothing
        for batch in batches:
            sets, keys = [], []
            for shingles in shingle_sets(batch.column("text"), plan.shingle):
                if not len(shingles) or (own := _set_id(shingles)) in seen:
                    continue
                if len(seen) >= 100_000:
                    seen.clear()
                seen[own] = None
                found = plan.keys(shingles)
                keys.append(found)
                sets.append(np.full(len(found), own, np.int64))
                if sum(map(len, keys[-50:])) > 500_000 or len(keys) >= 2000:
                    yield _key_batch(keys, sets)
                    keys, sets = [], []
            yield _key_batch(keys, sets)

    return run


def _key_batch(keys: list[np.ndarray], sets: list[np.ndarray]) -> pa.RecordBatch:
    join = lambda parts: np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(join(keys)), pa.array(join(sets))], names=["bucket", "set"])


def _near(plan: Plan):
    """Pairs whose short sketches do not rule them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = [batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b", "size_a", "size_b")]
            for n, (x, y, m, k) in enumerate(zip(*columns)):
                if min(m, k) * plan.below < max(m, k) * plan.above:
                    continue
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                apart = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
                if apart <= plan.difference(m + k):
                    keep.append(n)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _verify(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            for n, y in enumerate(shingle_sets(batch.column("text_b"), plan.shingle)):
                a = batch.column("a")[n].as_py()
                if last[0] != a:
                    last = (a, next(shingle_sets(batch.column("text_a").slice(n, 1), plan.shingle)))
                common = len(np.intersect1d(last[1], y, assume_unique=True))
                if plan.below * common >= plan.above * (len(last[1]) + len(y) - common):
                    keep.append(n)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


class _Join:
    """The sets of one table, and how candidate pairs of them are checked."""

    def __init__(self, docs: DataFrame, plan: Plan):
        self.plan = plan
        self.docs = docs
        self.profiles = checkpointed(docs.withColumn("copy", F.xxhash64("text")).mapInArrow(_profiles(plan), "key bigint, copy bigint, set bigint, size bigint, sketch binary, " + ", ".join(f"{c} bigint" for c in _FIXED) + ", needs map<int, bigint>"))
        self.sets = checkpointed(
            self.profiles.where("set is not null").groupBy("set")
            .agg(F.min("key").alias("key"), F.first("size").alias("size"), F.first("sketch").alias("sketch"), *[F.first(c).alias(c) for c in [*_FIXED, "needs"]])
        )

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of sets that are similar."""
        side = lambda x: self.sets.select(F.col("set").alias(x), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}"))
        near = checkpointed(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_near(self.plan), "a bigint, b bigint"))
        texts = checkpointed(self.texts(near.select(F.col("a").alias("set")).union(near.select("b")).distinct()))
        side = lambda x: texts.select(F.col("set").alias(x), F.col("text").alias(f"text_{x}"))
        paired = near.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
        return checkpointed(paired.mapInArrow(_verify(self.plan), "a bigint, b bigint"))

    def texts(self, needed: DataFrame) -> DataFrame:
        """set and text, one text for each needed set. The documents are picked by their keys,
        then by the set computed anew, since keys may repeat or be null. While there are few,
        the wanted keys are broadcast, so that other texts are not shuffled."""
        wanted = checkpointed(needed.join(self.sets.select("set", "key"), "set"))
        few = wanted.count() <= 1_000_000  # 16 bytes each
        keys = wanted.select(F.col("key").alias("own")).where("own is not null").distinct()
        picked = self.docs.join(F.broadcast(keys) if few else keys, F.col("key") == F.col("own"), "left_semi").select("text")
        unnamed = self.docs.where("key is null").select("text")
        plan = self.plan

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [_set_id(s) if len(s) else None for s in shingle_sets(batch.column("text"), plan.shingle)]
                yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), batch.column("text")], names=["set", "text"])

        named = picked.union(unnamed).mapInArrow(run, "set bigint, text string")
        ids = wanted.select("set")
        return named.join(F.broadcast(ids) if few else ids, "set", "left_semi").groupBy("set").agg(F.first("text").alias("text"))


def _labelled(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``rows`` with the component of the set in ``column`` (itself where it has no link)."""
    known = labels.select(F.col("node").alias("tf_node"), "component")
    joined = rows.join(known, F.col(column) == F.col("tf_node"), "left").drop("tf_node")
    return joined.withColumn(f"in_{column}", F.coalesce("component", column)).drop("component")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose two sets are in different components."""
    return _labelled(_labelled(pairs, labels, "a"), labels, "b").where("in_a <> in_b").select("a", "b")


def _bucket_pairs(members: DataFrame, plan: Plan) -> DataFrame:
    """set and other of the members of a bucket that are in different components and that the
    sizes and the Hamming distance of their fixed sketches, a lower bound of the difference, do
    not rule out. The bounds are part of the join's condition, so a large family of documents
    alike below the threshold is compared, but makes no rows."""
    left = members.select(*[F.col(c).alias(f"a_{c}" if c in _FIXED else c) for c in ("bucket", "set", "in_set", "size", *_FIXED)])
    right = members.select(*[F.col(c).alias(f"b_{c}") for c in ("bucket", "set", "in_set", "size", *_FIXED)])
    apart = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in _FIXED[1:]), F.bit_count(F.col("a_s0").bitwiseXOR(F.col("b_s0"))))
    fits = (
        (F.col("bucket") == F.col("b_bucket")) & (F.col("set") < F.col("b_set")) & (F.col("in_set") != F.col("b_in_set"))
        & (F.least("size", "b_size") * plan.below >= F.greatest("size", "b_size") * plan.above)
        & (apart * (plan.below + plan.above) <= (F.col("size") + F.col("b_size")) * (plan.below - plan.above))
    )
    return left.join(right, fits).select("set", F.col("b_set").alias("other"))


def _open(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component."""
    whole = Window.partitionBy("bucket")
    ends = members.select("*", F.min("in_set").over(whole).alias("low"), F.max("in_set").over(whole).alias("high"))
    return ends.where("low <> high").drop("low", "high")


def _rarest(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of open buckets without those of the most frequent ones of each set and band,
    by one fewer than any similar set has in common with it. Similar sets of different components
    agree in open buckets only, so in one order of these they still share the first; what
    shares fewer buckets than that is no longer brought together by all of them."""
    sized = members.withColumn("times", F.count("*").over(Window.partitionBy("bucket")))
    band = F.col("bucket").bitwiseAND(F.lit((1 << BAND_BITS) - 1)).cast("int")
    known = sized.join(sets.select("set", "needs"), "set").select("bucket", "set", "in_set", "times", band.alias("band"), F.coalesce(F.col("needs")[band], F.lit(1)).alias("need"))
    place = F.row_number().over(Window.partitionBy("set", "band").orderBy(F.desc("times"), F.desc("bucket")))
    return _open(known.withColumn("place", place).where("place >= need").select("bucket", "set", "in_set"))


def _set_components(join: _Join) -> DataFrame:
    """node and component of every set with a link.

    Each bucket's members are first compared with its smallest. Buckets that then hold more than
    one component go on without the most frequent ones of each set, and their members are
    compared with PIVOTS others picked by hash: both at a cost linear in the
    bucket, and enough to join up a group of near copies. In buckets that still hold more than
    one component every two members of different components are compared (sketches first), so
    that no link is lost; these are the sets that agree in a block and yet have no link.
    """
    plan, spark = join.plan, join.docs.sparkSession
    labels = spark.createDataFrame([], "node bigint, component bigint")
    tried = spark.createDataFrame([], "a bigint, b bigint")
    whole = Window.partitionBy("bucket")
    members = join.docs.mapInArrow(_keyed(plan), "bucket bigint, set bigint")
    shared = members.select("*", F.min("set").over(whole).alias("a"), F.max("set").over(whole).alias("z")).where("a <> z")
    shared = checkpointed(shared.select("bucket", "set", "a").distinct())
    for step in ("smallest", "pivots", "all"):
        placed = _labelled(shared.select("bucket", "set"), labels, "set")
        if step == "smallest":
            pairs = shared.select("a", F.col("set").alias("b"))
        else:
            shared = _open(placed)
            shared = checkpointed(_rarest(shared, join.sets) if step == "pivots" else shared)
            if step == "pivots":
                some = F.array(*[F.struct(F.min_by("set", F.xxhash64("set", F.lit(k))).alias("set"), F.min_by("in_set", F.xxhash64("set", F.lit(k))).alias("label")) for k in range(PIVOTS)])
                chosen = shared.groupBy("bucket").agg(some.alias("p")).select("bucket", F.explode(F.array_distinct("p")).alias("p"))
                joined = shared.join(chosen, "bucket").where("in_set <> p.label").select("set", F.col("p.set").alias("other"))
            else:
                joined = _bucket_pairs(shared.join(join.sets.select("set", "size", *_FIXED), "set"), plan)
            pairs = joined.select(F.least("set", "other").alias("a"), F.greatest("set", "other").alias("b"))
        pairs = checkpointed(pairs.where("a <> b").distinct().join(tried, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            tried = tried.union(pairs)
            labels = more_components(labels, join.links(pairs))
    return labels


def linked(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, above: int = 80, below: int = 100,
) -> DataFrame:
    """``key``, n_shingles and component_id of every row: documents are linked when
    ``below`` * shared >= ``above`` * united shingles, and a component's id is the smallest key
    in it.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text of fewer words
    than a shingle is one shingle. Null and empty texts have none, link with nothing and are
    their own component. A null key takes part; a component of null keys alone has a null id.
    Equal sets - copies, repeated rows - are one node of the graph. Other columns are not read,
    so their names cannot clash. An empty table gives no rows.

    Sets are told apart by 64-bit hashes of 64-bit shingle hashes.
    """
    plan = Plan(above, below, shingle)
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        join = _Join(docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")), plan)
        labels = checkpointed(_set_components(join))
    placed = _labelled(join.sets.select("set", "key"), labels, "set")
    names = placed.groupBy("in_set").agg(F.min("key").alias("component_id"))
    named = placed.join(names, "in_set").select("set", "component_id")
    rows = join.profiles.select(F.col("key").alias("tf_key"), F.col("set").alias("tf_set"), F.col("size").alias("n_shingles"))
    return rows.join(named, F.col("tf_set") == F.col("set"), "left").select(
        F.col("tf_key").alias(key), "n_shingles", F.when(F.col("tf_set").isNull(), F.col("tf_key")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, above: int = 80, below: int = 100,
) -> DataFrame:
    """The rows of ``docs`` without those that ``linked`` ties to another: one row of each
    component stays.

    It is the row with the smallest key (null last), of several texts with that key the one
    whose hash is smallest, and of rows that repeat key and text any one. Rows are decided one
    by one, so a key with two texts may lose one and keep the other. Rows without words stay.
    Rows are told apart by key and a 64-bit hash of the text.
    """
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        join = _Join(docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")), Plan(above, below, shingle))
        rows = join.profiles.where("set is not null").groupBy("key", "copy", "set").agg(F.count("*").alias("n"))
        rows = checkpointed(_labelled(rows, _set_components(join), "set").select("key", "copy", "n", "in_set"))
    order = F.struct(F.col("key").isNull().alias("nameless"), "key", "copy")
    best = rows.groupBy("in_set").agg(F.min(order).alias("best"), F.sum("n").alias("total")).where("total > 1")
    placed = checkpointed(rows.join(best, "in_set").select(F.col("key").alias("tf_key"), F.col("copy").alias("tf_copy"), "n", (order == F.col("best")).alias("stays")).where("n > 1 or not stays"))

    def named(part: DataFrame) -> DataFrame:
        part = part.select("tf_key", "tf_copy")
        return F.broadcast(part) if part.count() <= BROADCAST_ROWS else part

    same = F.col(key).cast("bigint").eqNullSafe(F.col("tf_key")) & (F.xxhash64(text) == F.col("tf_copy"))
    left = docs.join(named(placed.where("not stays")), same, "left_anti")
    repeats = placed.where("stays")
    if repeats.isEmpty():
        return left
    repeats = named(repeats)
    return left.join(repeats, same, "left_anti").unionByName(left.join(repeats, same, "left_semi").dropDuplicates([key, text]))
