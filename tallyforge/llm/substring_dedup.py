"""Passages that repeat across documents, by MinHash banding of paragraphs.

Line breaks do not mark passages that sit inside a longer line, so paragraphs are cut by
content: winnowing picks a word wherever its shingle hash is the smallest of a run, and the
PARAGRAPH words from there on are a paragraph. Two texts that share REACH words share such a
paragraph, wherever it stands. Paragraphs whose MinHash bands collide are compared by the exact
Jaccard similarity of their shingles; connected ones are one passage, kept in the document with
the smallest id and removed from the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pyspark.sql.types as T
from pyspark.sql import DataFrame, Window

from tallyforge.session import checkpointed

from .components import more_components
from .textops import SPACED, Words, mix, pieces, sliding, windows_hash

SHINGLE = 5
PARAGRAPH = 32
WINNOW = 19
#: Any passage of so many words shared word by word is found.
REACH = PARAGRAPH + WINNOW - 1
#: Bands of ROWS MinHash values: at a similarity of 0.8 one pair of paragraphs collides with
#: 1 - (1 - 0.8^2)^5 = 99.4 %.
BANDS = 5
ROWS = 2
#: The last bits of a bucket are the number of its band.
BAND_MASK = 7
#: Members besides the first holder that all members of a bucket are compared with.
PIVOTS = 3
#: 64-bit words of a paragraph's parity sketch.
SKETCH_WORDS = 4
#: Contents a task remembers, to send copies once.
SEEN = 200_000
#: A table is broadcast while it has at most so many rows and bytes (the driver holds it several
#: times); one whose rows hold lists is soon too large for that, however few they are.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 16 << 20
#: Members of a bucket that meet all of its members in one task: so many that comparing a row
#: costs far more than sending it to one more task.
TILE = 4096
#: Members of a bucket whose pairs may all become rows. Those of larger ones are compared in blocks
#: of two times BLOCK members, and make no more rows than members.
DENSE = 64
BLOCK = 512
#: Open buckets are worked on in up to SLICES slices of at least so many members, one after
#: another: what is shuffled for a slice goes before the next one begins.
SLICES = 8
SLICE_ROWS = 500_000
#: Shingles are counted in so many slots (by their leading bits) to tell rare ones from frequent.
SLOT_BITS = 16


class Paragraphs:
    """The paragraphs of some texts: text number, first word (in the text), content hash."""

    def __init__(self, words: Words, bands: bool = True):
        row, hashes = words.row, words.hashes()
        self.row = row
        shingles = windows_hash(hashes, SHINGLE)
        least = sliding(shingles, WINNOW)
        none = np.zeros(0, np.int64)
        self.text = self.at = none
        self.shingles = shingles
        if not len(least):
            self.content, self.keys = np.zeros(0, np.uint64), np.zeros((BANDS, 0), np.uint64)
            return
        text_of = np.repeat(np.arange(len(row) - 1), np.diff(row))
        # A run counts if its shingles are all of one text: runs are never mixed across texts.
        run_ok = text_of[: len(least)] == text_of[WINNOW + SHINGLE - 2 : WINNOW + SHINGLE - 2 + len(least)]
        bound = np.where(run_ok, least, np.uint64(0))
        padded = np.concatenate([np.zeros(WINNOW - 1, np.uint64), bound, np.zeros(WINNOW - 1, np.uint64)])
        chosen = sliding(padded, WINNOW, np.maximum)[: len(shingles)] == shingles
        chosen &= shingles != 0
        start = np.flatnonzero(chosen)
        start = start[start + PARAGRAPH <= row[text_of[start] + 1]]
        self.text, self.at = text_of[start], start
        total = np.zeros(len(start), np.uint64)
        for k in range(PARAGRAPH):
            total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[start + k]
        self.content = mix(total)
        keys = []
        width = PARAGRAPH - SHINGLE + 1
        for band in range(BANDS if bands else 0):
            key = np.full(len(start), band + 1, np.uint64)
            for k in range(ROWS):
                seed = np.uint64((2 * (band * ROWS + k) + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
                low = sliding((shingles ^ seed) * (seed | np.uint64(1)), width)
                key = mix(key * np.uint64(31) + mix(low[start]))
            keys.append(key)
        self.keys = np.stack(keys) if keys else np.zeros((0, len(start)), np.uint64)

    def first_word(self) -> np.ndarray:
        return self.at - self.row[self.text]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket (its last bits are the band), content and doc. Of the holders of a content in one
    task two different documents are enough here: all are looked up once passages are known."""
    seen: dict[int, int | None] = {}
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        for first, end, raw, at in pieces(batch.column("text")):
            found = Paragraphs(Words(raw, at, SPACED))
            owner = keys[first:end][found.text]
            keep = []
            for n, (content, doc) in enumerate(zip(found.content.tolist(), owner.tolist())):
                if content not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen[content] = doc
                elif seen[content] is None or seen[content] == doc:
                    continue
                else:
                    seen[content] = None
                keep.append(n)
            keep = np.array(keep, np.int64)
            buckets = (found.keys[:, keep] & ~np.uint64(BAND_MASK)) | np.arange(BANDS, dtype=np.uint64)[:, None]
            yield pa.RecordBatch.from_arrays(
                [_signed(buckets.ravel()), _signed(np.tile(found.content[keep], BANDS)), pa.array(np.tile(owner[keep], BANDS), pa.int64())],
                names=["bucket", "content", "doc"],
            )


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every paragraph: doc, at, content."""
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        for first, end, raw, at in pieces(batch.column("text")):
            found = Paragraphs(Words(raw, at, SPACED), bands=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[first:end][found.text], pa.int64()), pa.array(found.first_word().astype(np.int32)), _signed(found.content)],
                names=["doc", "at", "content"],
            )


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bits: those of two sets differ in no more places than the sets in shingles."""
    bits = 64 * SKETCH_WORDS
    flips = np.bincount((mix(shingles) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """content, distinct shingles and their sketch of the wanted contents of each text."""
    for batch in batches:
        contents, shingles, sketches = [], [], []
        wanted = batch.column("wanted").to_pylist()
        for first, end, raw, at in pieces(batch.column("text")):
            found = Paragraphs(Words(raw, at, SPACED), bands=False)
            for k in range(first, end):
                own = slice(*np.searchsorted(found.text, [k - first, k - first + 1]))
                asked = set(wanted[k])
                for c, s in zip(found.content[own].view(np.int64).tolist(), found.at[own].tolist()):
                    if c in asked:
                        asked.remove(c)
                        distinct = np.unique(found.shingles[s : s + PARAGRAPH - SHINGLE + 1])
                        contents.append(c)
                        shingles.append(distinct.view(np.int64))
                        sketches.append(_sketch(distinct))
        yield pa.RecordBatch.from_arrays([pa.array(contents, pa.int64()), pa.array(shingles, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))], names=["content", "shingles", "sketch"])


def _numbers(kind: T.DataType) -> int:
    """Numbers in a value without lists, and one more for a struct."""
    return 1 + sum(_numbers(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else 1


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast while it has at most BROADCAST_ROWS rows and BROADCAST_BYTES, its lists counted,
    else joined by a shuffle."""
    kept = checkpointed(df)
    lists = [F.coalesce(F.size(f.name), F.lit(0)) * (8 * _numbers(f.dataType.elementType)) for f in kept.schema.fields if isinstance(f.dataType, T.ArrayType)]
    own = reduce(lambda a, b: a + b, lists, F.lit(8 * (1 + len(kept.columns))))
    size = kept.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(own.cast("bigint")), F.lit(0)).alias("bytes")).first()
    return F.broadcast(kept) if size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES else kept


def _fits(above: float) -> F.Column:
    """Whether the Hamming distance of the sketches of a and b, a lower bound of the difference,
    does not rule the pair out."""
    apart = sum((F.bit_count(F.col(f"a_s{k}").bitwiseXOR(F.col(f"b_s{k}"))) for k in range(1, SKETCH_WORDS)), F.bit_count(F.col("a_s0").bitwiseXOR(F.col("b_s0"))))
    return apart * (1 + above) <= (F.col("a_n") + F.col("b_n")) * (1 - above) + 1e-6


def _near(pairs: DataFrame, sets: DataFrame, above: float) -> DataFrame:
    """The pairs that their sketches do not rule out; no shingles are sent for it."""
    side = lambda c: sets.select(F.col("content").alias(c), F.col("n").alias(f"{c}_n"), *[F.col("sketch")[k].alias(f"{c}_s{k}") for k in range(SKETCH_WORDS)])
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_fits(above)).select("a", "b")


def _similar(pairs: DataFrame, sets: DataFrame, above: float) -> DataFrame:
    """The pairs (a, b) of contents whose shingles are similar. Only the shingles of pairs that
    their sketches leave are sent."""
    near = checkpointed(_near(pairs, sets, above))
    needed = near.select(F.col("a").alias("content")).union(near.select("b")).distinct()
    needed = sets.join(_bounded(needed), "content", "left_semi")
    side = lambda c, s: needed.select(F.col("content").alias(c), F.col("s").alias(s))
    both = near.join(side("a", "x"), "a").join(side("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= F.lit(above) * (F.size("x") + F.size("y") - common)).select("a", "b")


def _member_pairs(members: DataFrame, above: float) -> DataFrame:
    """a and b of the members of a bucket that are in different components and that the Hamming
    distance of their sketches, a lower bound of the difference, does not rule out. The bounds
    are part of the join's condition: paragraphs alike below the threshold make no rows. A
    bucket of more than TILE members is split into tiles of about that many, each met by all
    members in a task of its own."""
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    names = ("bucket", "content", "low", "high", "label", "n", *(f"s{k}" for k in range(SKETCH_WORDS)))
    left, right = (
        members.select(*[F.col(c).alias(f"{side}_{c}") for c in names], tile.alias(f"{side}_tile"))
        for side, tile in (("a", F.pmod(F.xxhash64("content"), tiles).cast("int")), ("b", F.explode(F.sequence(F.lit(0), tiles - 1))))
    )
    fits = (
        (F.col("a_bucket") == F.col("b_bucket")) & (F.col("a_tile") == F.col("b_tile")) & (F.col("a_content") < F.col("b_content")) & (F.col("a_label") != F.col("b_label"))
        & (F.least("a_low", "b_low") != F.greatest("a_high", "b_high"))
        & _fits(above)
    )
    return left.join(right, fits).select(F.col("a_content").alias("a"), F.col("b_content").alias("b"))


def _forest(above: float):
    """Links between the members of a block that lie in different components, as few as connect
    what they connect. A block has the members of one part of a bucket, or those of two parts,
    which then only meet across."""

    def run(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        content, label, low, high, part = (block.column(c).to_numpy() for c in ("content", "label", "low", "high", "part"))
        size = block.column("n").to_numpy().astype(np.int64)
        sketch = np.stack([block.column(f"s{k}").to_numpy() for k in range(SKETCH_WORDS)], 1).view(np.uint64)
        sets = block.column("s")
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        one, two = key[1].as_py(), key[2].as_py()
        rows, others = np.flatnonzero(part == one), np.flatnonzero(part == two)
        out: list[tuple[int, int]] = []
        for k in rows.tolist():
            apart = np.bitwise_count(sketch[others] ^ sketch[k]).sum(1)
            near = (apart * (1 + above) <= (size[others] + size[k]) * (1 - above) + 1e-6) & (label[others] != label[k])
            near &= np.minimum(low[others], low[k]) != np.maximum(high[others], high[k])
            if one == two:
                near &= content[others] > content[k]
            for m in others[near].tolist():
                x, y = top(int(label[k])), top(int(label[m]))
                if x != y:
                    common = len(np.intersect1d(sets[k].values.to_numpy(), sets[m].values.to_numpy(), assume_unique=True))
                    if common >= above * (size[k] + size[m] - common):
                        root[x] = y
                        out.append((int(content[k]), int(content[m])))
        found = np.sort(np.array(out, np.int64).reshape(-1, 2), 1)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return run


def _block_links(members: DataFrame, sets: DataFrame, above: float) -> DataFrame:
    """Links (a, b) that connect the members of each bucket as all their links do. Every two
    members meet, in blocks of bounded size that are tasks of their own, with their shingles; a
    block makes at most a row for each member, however many are alike."""
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = members.withColumn("part", F.pmod(F.xxhash64("content"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    wide = placed.join(sets.select("content", "n", "s", *[F.col("sketch")[k].alias(f"s{k}") for k in range(SKETCH_WORDS)]), "content")
    ends = wide.withColumn("one", F.least("part", "other")).withColumn("two", F.greatest("part", "other")).drop("other", "size")
    return ends.groupBy("bucket", "one", "two").applyInArrow(_forest(above), "a bigint, b bigint")


def _rare(sets: DataFrame, above: float) -> DataFrame:
    """content and rare: the rarest shingles of each set, so many that two similar sets share one
    of them. A set of n shingles shares at least above * n with a similar one; in one order of
    all shingles, n + 1 less that number from its start cannot miss those of the other."""
    bits = np.uint64(64 - SLOT_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            flat = batch.column("s").flatten().to_numpy().view(np.uint64)
            total += np.bincount((flat >> bits).astype(np.int64), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "times"])

    counted = sets.select("s").mapInArrow(count, "slot bigint, times bigint").groupBy("slot").agg(F.sum("times").alias("times")).toArrow()
    often = np.zeros(1 << SLOT_BITS, np.int64)
    often[counted.column("slot").to_numpy()] = counted.column("times").to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(often)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("s").flatten().to_numpy().view(np.uint64)
            size = batch.column("s").value_lengths().to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((flat, shared.value[flat >> bits], row))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            first = size + 1 - np.ceil(above * size - 1e-9).astype(np.int64)
            keep = place < first[row]
            yield pa.RecordBatch.from_arrays([batch.column("content").take(pa.array(row[keep])), _signed(flat[order][keep])], names=["content", "rare"])

    return sets.select("content", "s").mapInArrow(pick, "content bigint, rare bigint")


def _finer(members: DataFrame, sets: DataFrame, above: float, rare: DataFrame | None = None) -> DataFrame:
    """The members of open buckets in finer ones, of those that share a rare shingle too. Similar
    members of a bucket still meet; those that share what is frequent alone do not. A member
    makes a row for each of its rare shingles, however large its bucket."""
    keyed = members.join(_rare(sets, above) if rare is None else rare, "content").select(F.xxhash64("bucket", "rare").alias("bucket"), "content", "low", "high", "label")
    return checkpointed(_open(keyed))


def _open(members: DataFrame) -> DataFrame:
    """The members, with its size, of each bucket that holds several components and documents."""
    whole = Window.partitionBy("bucket")
    ends = members.select(
        "*", F.count("*").over(whole).alias("size"), F.min("label").over(whole).alias("least"), F.max("label").over(whole).alias("most"),
        F.min("low").over(whole).alias("from"), F.max("high").over(whole).alias("to"),
    )
    return ends.where("least <> most and from <> to").drop("least", "most", "from", "to")


def _open_pairs(members: DataFrame, sets: DataFrame, above: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) and links (a, b) of the members of open buckets: of finer buckets of up to DENSE
    members the pairs to compare, of others links. A bucket lies in one slice with all its members,
    and so do the finer ones cut from it."""
    slices = min(SLICES, 1 + members.count() // SLICE_ROWS)
    rare = checkpointed(_rare(sets, above))
    sketches = sets.select("content", "n", *[F.col("sketch")[k].alias(f"s{k}") for k in range(SKETCH_WORDS)])
    pairs, links = [], []
    for k in range(slices):
        finer = _finer(members.where(F.pmod(F.xxhash64("bucket"), F.lit(slices)) == k), sets, above, rare)
        few = finer.where(F.col("size") <= DENSE)
        pairs.append(checkpointed(_member_pairs(few.join(sketches, "content"), above).distinct()))
        links.append(checkpointed(_block_links(finer.where(F.col("size") > DENSE), sets, above)))
    return reduce(DataFrame.union, pairs), reduce(DataFrame.union, links)


def _passages(members: DataFrame, sets: DataFrame, above: float) -> DataFrame:
    """node and component of every content that is similar to one of another document.

    The members of a bucket are first compared with its first holder and with PIVOTS others
    picked by hash, at a cost linear in the bucket. Buckets that still hold more than one
    component are cut finer, by the rare shingles of their members; in those, every two members
    of different components are compared (sketches first): as a join in buckets of up to DENSE
    members, else in blocks. Contents of one and the same document
    are never linked to each other: its windows overlap.
    """
    spark = members.sparkSession
    labels = spark.createDataFrame([], "node bigint, component bigint")
    tried = spark.createDataFrame([], "a bigint, b bigint")
    members = members.withColumn("label", F.col("content"))  # of buckets with several contents and documents
    for step in ("pivots", "all"):
        if step == "all":
            known = labels.select(F.col("node").alias("content"), "component")
            placed = members.drop("label").join(known, "content", "left").withColumn("label", F.coalesce("component", "content")).drop("component")
            joined, links = _open_pairs(checkpointed(_open(placed).select("bucket", "content", "low", "high", "label")), sets, above)
            if not links.isEmpty():
                labels = more_components(labels, links)
        else:
            chosen = F.struct("content", "low", "high", "label")
            some = F.array(F.min_by(chosen, F.struct("low", "content")), *[F.min_by(chosen, F.xxhash64("content", F.lit(k))) for k in range(PIVOTS)])
            pivots = members.groupBy("bucket").agg(some.alias("p")).select("bucket", F.explode(F.array_distinct("p")).alias("p"))
            met = members.join(pivots, "bucket").where(F.col("label") != F.col("p.label")).where(F.least("low", "p.low") != F.greatest("high", "p.high"))
            joined = met.select(F.least("content", "p.content").alias("a"), F.greatest("content", "p.content").alias("b"))
        pairs = checkpointed(joined.distinct().join(tried, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            tried = tried.union(pairs)
            labels = more_components(labels, _similar(pairs, sets, above))
    return labels


def repeated(docs: DataFrame, key: str, text: str, above: float = 0.8) -> DataFrame:
    """doc, at, content and first: each paragraph that an earlier document holds, and which."""
    base = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    units = base.mapInArrow(_units, "bucket bigint, content bigint, doc bigint")
    whole = Window.partitionBy("bucket")
    shared = units.select(
        "bucket", "content", "doc", F.min("doc").over(whole).alias("from"), F.max("doc").over(whole).alias("to"),
        (F.min("content").over(whole) != F.max("content").over(whole)).alias("mixed"),
    ).where(F.col("from") != F.col("to")).where(F.col("mixed") | (F.col("bucket").bitwiseAND(F.lit(BAND_MASK)) == 0))
    shared = checkpointed(shared.groupBy("bucket", "content", "mixed").agg(F.min("doc").alias("low"), F.max("doc").alias("high")))
    members = shared.where("mixed").select("bucket", "content", "low", "high")
    labels = docs.sparkSession.createDataFrame([], "node bigint, component bigint")
    if not members.isEmpty():
        wanted = members.select("low", "content").distinct().groupBy(F.col("low").alias("doc")).agg(F.collect_list("content").alias("wanted"))
        sets = base.join(_bounded(wanted), F.col("key") == F.col("doc")).select("text", "wanted")
        sets = sets.mapInArrow(_extract, "content bigint, shingles array<bigint>, sketch array<bigint>")
        sets = checkpointed(sets.groupBy("content").agg(F.first("shingles").alias("s"), F.first("sketch").alias("sketch")).withColumn("n", F.size("s")))
        labels = _passages(members, sets, above)
    copies = shared.where("low <> high").select("content").distinct()
    known = labels.select(F.col("node").alias("content"), "component")
    passages = copies.join(known, "content", "full").select("content", F.coalesce("component", "content").alias("passage"))
    places = base.mapInArrow(_places, "doc bigint, at int, content bigint")
    placed = checkpointed(places.join(_bounded(passages), "content"))
    firsts = placed.groupBy("passage").agg(F.min("doc").alias("first"))
    return placed.join(_bounded(firsts), "passage").where("doc <> first").select("doc", "at", "content", "first")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", above: float = 0.8, prefix: str = "") -> DataFrame:
    """All columns of ``docs``, with repeated passages cut out of ``text``, and the new columns
    n_words, n_removed (words cut out) and kept_in (ids of the documents that keep the
    passages, ascending), their names led by ``prefix``.

    Null texts stay null, texts without a repeated passage stay as they are, byte by byte. A
    passage is cut from its first to its last word with the white space after it. Repetition
    inside one document, or in rows with equal ids, is not touched. Rows with a null key are
    kept whole and keep nothing for others. Lines and texts shorter than PARAGRAPH words are
    never a passage of their own. Long texts are worked on whole. An empty table gives no rows;
    a column with the name of a new one is an error.

    One shuffle of narrow rows, BANDS / 8 of a row per word. Copies of a paragraph are sent once
    by each task. Different paragraphs of a bucket are compared with a few of its members, at a
    linear cost, and what is then still unconnected pair by pair (sketches first).
    """
    new = [prefix + c for c in ("n_words", "n_removed", "kept_in")]
    if clash := set(docs.columns) & set(new):
        raise ValueError(f"columns {sorted(clash)} are there already: give a prefix")
    spans = repeated(docs, key, text, above).groupBy(F.col("doc").alias("tf_doc")).agg(F.collect_set(F.struct("at", "content")).alias("tf_spans"), F.array_sort(F.collect_set("first")).alias("tf_first"))
    joined = docs.join(_bounded(spans), F.col(key).cast("bigint") == F.col("tf_doc"), "left").drop("tf_doc")
    schema = T.StructType([*docs.schema.fields, T.StructField(new[0], T.LongType()), T.StructField(new[1], T.LongType()), T.StructField(new[2], T.ArrayType(T.LongType()))])
    columns, names = docs.columns, schema.names

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = batch.column(text)
            spans, firsts = batch.column("tf_spans").to_pylist(), batch.column("tf_first").to_pylist()
            texts, totals, gone, kept = [], [], [], []
            for low, high, raw, at in pieces(source):
                words = Words(raw, at, SPACED)
                for k in range(low, high):
                    a, b = words.row[k - low], words.row[k - low + 1]
                    totals.append(int(b - a))
                    value = source[k].as_py()
                    drop = np.zeros(b - a, bool)
                    if spans[k]:
                        one = np.array([0, at[k - low + 1] - at[k - low]])
                        own = Words(raw[at[k - low] : at[k - low + 1]], one, SPACED)
                        found = Paragraphs(own, bands=False)
                        asked = {(s["at"], s["content"]) for s in spans[k]}
                        for p, c in zip(found.at.tolist(), found.content.view(np.int64).tolist()):
                            if (p, c) in asked:  # not so where another row with this id has another text
                                drop[p : p + PARAGRAPH] = True
                        if drop.any():
                            value = _without(raw[at[k - low] : at[k - low + 1]].tobytes(), own, drop)
                    texts.append(value)
                    gone.append(int(drop.sum()))
                    kept.append(firsts[k] if drop.any() else [])
            kind = pa.large_string() if pa.types.is_large_string(source.type) else pa.string()
            out = [pa.array(texts, kind) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*out, pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.list_(pa.int64()))], names=names)

    return joined.mapInArrow(cut, schema)


def _without(data: bytes, words: Words, drop: np.ndarray) -> str:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], drop.astype(np.int8), [0]])))
    parts, at = [], 0
    for first, end in edges.reshape(-1, 2):
        parts.append(data[at : words.start[first]])
        at = words.start[end] if end < len(drop) else len(data)
    return b"".join([*parts, data[at:]]).decode()
