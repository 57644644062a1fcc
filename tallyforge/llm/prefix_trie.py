"""The trie of conversation prefixes: which beginnings conversations share, and what they cost.

Every prefix has a digest, the XOR of a hash of each turn and its place, so digests are running
values: conversations are sorted over all tasks and one that spans several of them is put
together from its parts. Distinct digests are the nodes; equal ones are checked to have the same
parent digest, depth and turn, which proves by induction that they stand for one sequence.

Subtrees of few rows are dealt to shards. A shard gives its nodes slots by a minimal perfect
hash (checked against the whole digest), scatters their counts into flat arrays, and adds them up
through the array of parent slots in depth order. The nodes above, few and with large subtrees,
make up the crown, which is added up last: in one such table while it is small, by doubling
pointers beyond that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyforge.session import checkpointed

from .textops import mix

#: Subtrees of at most so many turns (repeated ones counted) go to a shard as a whole.
SHARD_ROWS = 200_000
#: Nodes of a crown that one task adds up.
CROWN_ROWS = 200_000
#: Bytes of joined ids that travel as one row.
CHUNK_BYTES = 1 << 16


# --- running values over all tasks ---------------------------------------------------


def running(df: DataFrame, key: str, order: list[str], values: dict[str, np.ufunc]) -> DataFrame:
    """``df`` with the bigint columns ``values`` replaced by their running sum (np.add) or XOR
    (np.bitwise_xor) over the rows of the same key, in order.

    Rows are range-partitioned by key and order, so the rows of a large key are spread over
    several tasks. The driver learns one row per partition: where a key goes on in the next one.
    """
    spark, names = df.sparkSession, list(values)
    sort = [key, *order]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, last, carry = TaskContext.get().partitionId(), 0, None, dict.fromkeys(names, np.int64(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            own = np.repeat(starts, np.diff(np.append(starts, len(keys))))
            columns = {c: batch.column(c) for c in batch.schema.names}
            for c, op in values.items():
                plain = columns[c].to_numpy()
                if keys[0] == last:
                    plain = plain.copy()
                    plain[0] = op(plain[0], carry[c])
                total = op.accumulate(plain)
                before = np.concatenate([np.zeros(1, np.int64), total])[own]
                total = total ^ before if op is np.bitwise_xor else total - before
                carry[c] = total[-1]
                columns[c] = pa.array(total)
            last = keys[-1]
            rows = np.arange(done, done + len(keys))
            done += len(keys)
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(np.full(len(keys), part, np.int32)), pa.array(rows)], names=[*columns, "tf_part", "tf_row"]
            )

    placed = df.repartitionByRange(tasks, *sort).sortWithinPartitions(*sort)
    stored = checkpointed(placed.mapInArrow(scan, f"{fields}, tf_part int, tf_row bigint"))
    ends = stored.groupBy("tf_part").agg(F.min(key).alias("first"), F.max(key).alias("last"), *[F.max_by(c, "tf_row").alias(c) for c in names])
    last, carry, offsets = None, [0] * len(names), []
    for row in sorted(ends.collect()):
        ending = [np.int64(row[c]) for c in names]
        if row["first"] == last:
            offsets.append((row["tf_part"], last, *map(int, carry)))
            if row["last"] == last:
                ending = [op(x, y) for op, x, y in zip(values.values(), ending, carry)]
        last, carry = row["last"], ending
    more = spark.createDataFrame(offsets, "tf_in int, tf_key bigint, " + ", ".join(f"tf_before_{c} bigint" for c in names))
    met = stored.join(F.broadcast(more), (F.col("tf_part") == F.col("tf_in")) & (F.col(key) == F.col("tf_key")), "left")  # one row a partition at most

    def joined(c: str):
        offset = F.coalesce(f"tf_before_{c}", F.lit(0).cast("bigint"))
        return (F.col(c).bitwiseXOR(offset) if values[c] is np.bitwise_xor else F.col(c) + offset).alias(c)

    return met.select(*[joined(c) if c in values else F.col(c) for c in df.columns])


# --- conversations --------------------------------------------------------------------


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, at, a, b and size of every turn: its place in the conversation from 0 on, 128 bits
    of the SHA-256 of role and text, and the bytes of the text.

    Turns go in the order of ``turn``, null first, equal ones by that SHA-256 (repeated turns
    each count). A null role or text is empty. Rows without a conversation take no part. Other
    columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("hash"), F.octet_length(text).cast("bigint").alias("size"),
    )
    half = lambda k: F.conv(F.substring("hash", 16 * k + 1, 16), 16, -10).cast("bigint")
    rows = rows.select("conv", "turn", half(0).alias("a"), half(1).alias("b"), "size", F.lit(1).cast("bigint").alias("at"), F.monotonically_increasing_id().alias("own"))
    # "own" tells repeated rows apart, so that even a mass of them is spread over the tasks.
    placed = running(rows, "conv", ["turn", "a", "b", "own"], {"at": np.add})
    return placed.select("conv", (F.col("at") - 1).alias("at"), "a", "b", "size")


def with_shared_heads(rows: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others, from numbered turns: each conversation c is the
    first h turns of c - c % ``every`` (all if there are fewer, none if it is absent) and then
    its own turns after the first h, where h is crc32 of the decimal c modulo ``most``.

    Returns (conv, turns) of every conversation, also turnless ones, and the rows conv, at, a, b,
    size, and ``after``, the number of turns behind each.
    """
    rows = checkpointed(rows)
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n"))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    sizes = checkpointed(sizes.withColumn("h", head).withColumn("base", F.col("conv") - F.col("conv") % every))
    known = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = sizes.join(known, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0).cast("bigint"))))
    convs = checkpointed(convs.withColumn("turns", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("bigint"))).select("conv", "base", "h", "m", "turns"))
    borrowed = (
        rows.where(F.col("at") < most - 1).withColumnRenamed("conv", "base").join(convs, "base").where("at < h")
        .select("conv", "at", "a", "b", "size", "turns")
    )
    own = rows.join(convs, "conv").where("at >= h").select("conv", (F.col("m") + F.col("at") - F.col("h")).alias("at"), "a", "b", "size", "turns")
    both = borrowed.union(own).select("conv", "at", "a", "b", "size", (F.col("turns") - F.col("at") - 1).alias("after"))
    return convs.select("conv", "turns"), both


def as_they_are(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same two tables for conversations that are not rebuilt."""
    rows = checkpointed(rows)
    convs = checkpointed(rows.groupBy("conv").agg(F.count("*").alias("turns")))
    return convs, rows.join(convs, "conv").withColumn("after", F.col("turns") - F.col("at") - 1).drop("turns")


# --- slots ----------------------------------------------------------------------------


class Slots:
    """A minimal perfect hash of pairs of 64-bit values: n pairs get the slots 0 to n - 1.

    Pairs that are alone at their place of a bitmap get its rank, the others go on to the next,
    smaller one. A lookup is checked against the pair kept at the slot.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, spare: float = 1.5):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, used = np.arange(len(x)), 0
        slot = np.full(len(x), -1)
        for level in count():
            if not len(rest):
                break
            if level == 100:
                raise ValueError("a pair is there twice")
            place = self._place(x[rest], y[rest], level, int(spare * len(rest)) + 1)
            times = np.bincount(place, minlength=int(spare * len(rest)) + 1)
            rank = used + np.cumsum(times == 1) - 1
            alone = times[place] == 1
            slot[rest[alone]] = rank[place[alone]]
            self.levels.append((times == 1, rank))
            used += int(alone.sum())
            rest = rest[~alone]
        self.slot = slot
        self.x, self.y = np.empty_like(x), np.empty_like(y)
        self.x[slot], self.y[slot] = x, y

    @staticmethod
    def _place(x: np.ndarray, y: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return (mix(mix(x.view(np.uint64) + seed) ^ (y.view(np.uint64) * (seed | np.uint64(1)))) % np.uint64(size)).astype(np.int64)

    def find(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The slot of each pair, -1 for those that are not in the table."""
        slot, rest = np.full(len(x), -1), np.arange(len(x))
        for level, (bits, rank) in enumerate(self.levels):
            place = self._place(x[rest], y[rest], level, len(bits))
            hit = bits[place]
            slot[rest[hit]] = rank[place[hit]]
            rest = rest[~hit]
        some = slot >= 0
        some[some] = (self.x[slot[some]] == x[some]) & (self.y[slot[some]] == y[some])
        return np.where(some, slot, -1)


_NODE = "x bigint, y bigint, px bigint, py bigint, depth bigint, conv bigint, n_convs bigint"
_SUMS = "n_children bigint, n_leaves bigint, saved bigint"


def subtrees(table: pa.Table) -> pa.Table:
    """The nodes of a shard with their sums, and conv of the parent where it is in the shard.
    n_children, n_leaves and saved come in with what lies below the shard, and saved with the
    node's own part too."""
    read = lambda c: table.column(c).to_numpy()
    slots = Slots(read("x"), read("y"))
    at = slots.slot

    def scattered(c: str) -> np.ndarray:
        out = np.empty(len(at), np.int64)
        out[at] = read(c)
        return out

    parent = np.empty(len(at), np.int64)
    parent[at] = slots.find(read("px"), read("py"))
    depth, conv, saved = scattered("depth"), scattered("conv"), scattered("saved")
    parent[depth == 0] = -1  # the root's parent would be itself
    below = np.flatnonzero(parent >= 0)
    children = scattered("n_children") + np.bincount(parent[below], minlength=len(at))
    leaves = scattered("n_leaves") + (children == 0)
    below = below[np.argsort(-depth[below], kind="stable")]
    for level in np.split(below, np.flatnonzero(np.diff(depth[below])) + 1):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    above = pa.array(conv[parent][at], mask=(parent < 0)[at])
    out = table.select(["x", "y", "px", "py", "depth", "conv", "n_convs"])
    for name, column in (("n_children", children[at]), ("n_leaves", leaves[at]), ("saved", saved[at]), ("parent_conv", above)):
        out = out.append_column(name, pa.array(column))
    return out


# --- the trie -------------------------------------------------------------------------


def _digests(rows: DataFrame, seed: int) -> DataFrame:
    """The rows with the digest x, y of the prefix that ends there and that of its parent."""
    lane = lambda k: F.xxhash64(F.lit(2 * seed + k), "at", "a", "b")
    turned = rows.select("conv", "at", "a", "b", "size", "after", lane(0).alias("x"), lane(1).alias("y"), lane(0).alias("px"), lane(1).alias("py"))
    done = running(turned, "conv", ["at"], {"x": np.bitwise_xor, "y": np.bitwise_xor})
    return done.withColumns({"px": F.col("x").bitwiseXOR(F.col("px")), "py": F.col("y").bitwiseXOR(F.col("py"))})


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their digests, and the nodes: the distinct digests, proved to stand for one
    sequence each (other seeds are tried until they do)."""
    same = ("at", "a", "b", "px", "py", "size")
    for seed in range(8):
        stored = checkpointed(_digests(rows, seed))
        nodes = stored.groupBy("x", "y").agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.sum(F.col("after") + 1).alias("weight"),
            *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"most_{c}") for c in same],
        )
        nodes = nodes.withColumn("odd", F.array_contains(F.array(*[F.col(c) != F.col(f"most_{c}") for c in same]), True) | ((F.col("x") == 0) & (F.col("y") == 0)))
        nodes = checkpointed(nodes.select("x", "y", "px", "py", (F.col("at") + 1).alias("depth"), "conv", "n_convs", (F.col("size") * (F.col("n_convs") - 1)).alias("saved"), "weight", "odd"))
        if nodes.where("odd").isEmpty():
            return stored, nodes.drop("odd")
    raise ValueError("no seed without collisions")


def _ends(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """x, y and the SHA-256 of the ids of the conversations that end there, in order.

    The ids of a node are first joined to chunks by as many tasks as they are spread over; only
    the digest itself, which is sequential, is taken by one task, a chunk at a time.
    """
    tasks = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nothing = F.lit(0).cast("bigint")
    last = rows.where("after = 0").select("x", "y", "conv").union(convs.where("turns = 0").select(nothing, nothing, "conv"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0
        done: list[tuple] = []
        for batch in batches:
            for x, y, c in zip(*(batch.column(k).to_pylist() for k in ("x", "y", "conv"))):
                if (x, y) != node or size >= CHUNK_BYTES:
                    if ids:
                        done.append((*node, first, ",".join(ids)))
                    if len(done) >= 5000:
                        yield _rows(done)
                        done = []
                    node, first, ids, size = (x, y), c, [], 0
                ids.append(str(c))
                size += 1 + len(ids[-1])
        if ids:
            done.append((*node, first, ",".join(ids)))
        yield _rows(done)

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names=["x", "y", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for x, y, ids in zip(*(batch.column(k).to_pylist() for k in ("x", "y", "ids"))):
                if (x, y) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (x, y), hashlib.sha256()
                state.update(ids.encode())
            yield _found(out)
        yield _found([] if node is None else [(*node, state.hexdigest())])

    def _found(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in out], t) for k, t in enumerate(kinds)], names=["x", "y", "ends"])

    pieces = last.repartitionByRange(tasks, "x", "y", "conv").sortWithinPartitions("x", "y", "conv").mapInArrow(chunks, "x bigint, y bigint, first bigint, ids string")
    return pieces.repartition(tasks, "x", "y").sortWithinPartitions("x", "y", "first").mapInArrow(digest, "x bigint, y bigint, ends string")


def _doubled(crown: DataFrame, deepest: int) -> DataFrame:
    """The crown with its sums, by doubling: a node first has the sum of itself, then of all
    nodes less than 1, 2, 4, ... steps below, as each sends its sum so many steps up."""
    step = crown.withColumns({"jx": F.when(F.col("depth") > 0, F.col("px")), "jy": F.when(F.col("depth") > 0, F.col("py"))})
    reach = 1
    while reach <= deepest:
        step = checkpointed(step)
        sent = step.where("jx is not null").groupBy(F.col("jx").alias("sx"), F.col("jy").alias("sy")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        hop = step.select(F.col("x").alias("hx"), F.col("y").alias("hy"), F.col("jx").alias("nx"), F.col("jy").alias("ny"))
        moved = step.join(sent, (F.col("x") == F.col("sx")) & (F.col("y") == F.col("sy")), "left").join(hop, (F.col("jx") == F.col("hx")) & (F.col("jy") == F.col("hy")), "left")
        zero = F.lit(0).cast("bigint")
        step = moved.select(*crown.columns[:-2], (F.col("n_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"), F.col("nx").alias("jx"), F.col("ny").alias("jy"))
        reach *= 2
    return step.drop("jx", "jy")


def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 of every prefix of the conversations, from the two tables of
    ``as_they_are`` or ``with_shared_heads``. The prefix of no turns is the root; without
    conversations there is none. saved_tokens counts bytes: (n_convs - 1) times those of the
    last turn, over the subtree.

    No task holds a conversation, a node's members or a subtree of more than SHARD_ROWS rows.
    """
    spark = convs.sparkSession
    members, first, total = convs.agg(F.count("*"), F.min("conv"), F.coalesce(F.sum("turns"), F.lit(0))).first()
    if not members:
        return spark.createDataFrame([], "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")
    rows, nodes = _nodes(rows)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = max(1, min(SHARD_ROWS, -(-total // tasks)))
    root = spark.createDataFrame([(0, 0, 0, 0, 0, first, members, 0)], _NODE + ", saved bigint")
    crown = checkpointed(nodes.where(F.col("weight") > limit).drop("weight").union(root))
    light = nodes.where(F.col("weight") <= limit).drop("weight")

    # Each conversation leaves the crown once: below that node lies its shard.
    names = crown.select("x", "y")
    left = rows.select("conv", "at", "x", "y").join(names, ["x", "y"], "left_anti").groupBy("conv").agg(F.min_by(F.struct("x", "y"), "at").alias("top"))
    shard = F.pmod(F.xxhash64("top"), F.lit(-(-total // limit) or 1))
    zero = F.lit(0).cast("bigint")
    dealt = light.join(left, "conv").select(
        "x", "y", "px", "py", "depth", "conv", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), "saved", shard.alias("shard")
    )
    kind = f"{_NODE}, {_SUMS}, parent_conv bigint"
    done = checkpointed(dealt.groupBy("shard").applyInArrow(lambda table: subtrees(table), kind))

    tops = done.where("parent_conv is null")
    below = tops.groupBy("px", "py").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("more"))
    inner = crown.where("depth > 0").groupBy("px", "py").agg(F.count("*").alias("n_children"), zero.alias("n_leaves"), zero.alias("more"))
    sums = below.union(inner).groupBy(F.col("px").alias("sx"), F.col("py").alias("sy")).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "more")])
    high = checkpointed(
        crown.join(sums, (F.col("x") == F.col("sx")) & (F.col("y") == F.col("sy")), "left").select(
            "x", "y", "px", "py", "depth", "conv", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
            F.coalesce("n_leaves", zero).alias("n_leaves"), (F.col("saved") + F.coalesce("more", zero)).alias("saved"),
        )
    )
    if high.count() <= CROWN_ROWS:
        inside = crown.where("depth > 0").groupBy("px", "py").agg(F.count("*").alias("again"))  # counted anew by the table
        alone = high.join(inside, (high.x == inside.px) & (high.y == inside.py), "left").select(
            *[high[c] for c in ("x", "y", "px", "py", "depth", "conv", "n_convs")], (F.col("n_children") - F.coalesce("again", zero)).alias("n_children"), "n_leaves", "saved"
        )
        summed = alone.withColumn("shard", F.lit(0)).groupBy("shard").applyInArrow(lambda table: subtrees(table), kind).drop("parent_conv")
    else:
        own = high.withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
        summed = _doubled(own, high.agg(F.max("depth")).first()[0])
    summed = checkpointed(summed)
    above = crown.select(F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("conv").alias("parent_conv"))
    parent = (F.col("px") == F.col("ax")) & (F.col("py") == F.col("ay")) & (F.col("depth") > 0)
    open_ended = tops.drop("parent_conv").union(summed).join(above, parent, "left").drop("ax", "ay")
    all_nodes = done.where("parent_conv is not null").unionByName(open_ended)
    ends = _ends(convs, rows)
    return all_nodes.join(ends, ["x", "y"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of a table of turns; see ``numbered`` for their order, nulls and repeats."""
    return trie(*as_they_are(numbered(turns, conv, turn, role, text)))
