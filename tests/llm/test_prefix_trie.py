"""The prefix trie against plain dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallyforge.llm import prefix_trie as P

SCHEMA = "conv_id long, turn int, role string, text string, x string, at string, conv string"


def content(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def conversations(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, content(role or "", text or ""), (role or "", text or "")))
    return {c: [x[-1] for x in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(np.fmod(c, 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)

    sums = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below = [sums[k] for k in kids[path]]
        sums[path] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    out = []
    for path, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), len(kids[path]), *sums[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(parts)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sample(seed):
    r = random.Random(seed)
    rows = [(c, t, r.choice(["user", "bot", None]), r.choice(["a", "bé", "", None])) for c in range(-12, 60) for t in range(r.randrange(1, 7))]
    rows += [(c, t, "user", "same") for c in range(100, 140) for t in range(3)]  # a conversation many times
    rows += [(200, t % 50, "user", f"{t % 9}") for t in range(150)]  # a long one, with equal turns
    rows += [(201, None, "user", "first"), (201, 1, "user", "second"), (201, 1, "user", "second"), (None, 1, "user", "lost")]
    return rows


@pytest.mark.parametrize("shard,crown,chunk", [(200_000, 200_000, 1 << 16), (3, 200_000, 8), (3, 2, 1)])
def test_like_dictionaries(spark, monkeypatch, shard, crown, chunk):
    """In shards of a few nodes too, with the crown in one table or by doubling."""
    monkeypatch.setattr(P, "SHARD_ROWS", shard)
    monkeypatch.setattr(P, "CROWN_ROWS", crown)
    monkeypatch.setattr(P, "CHUNK_BYTES", chunk)
    rows = sample(shard)
    assert result(P.prefix_trie(table(spark, rows))) == brute(conversations(rows))
    turns = P.numbered(table(spark, rows))
    assert result(P.trie(*P.with_shared_heads(turns))) == brute(rebuilt(conversations(rows)))


def test_few_rows(spark):
    assert result(P.prefix_trie(table(spark, [], 1))) == []
    assert result(P.prefix_trie(table(spark, [(None, 1, "a", "b")], 1))) == []
    one = [(7, 1, None, None)]
    assert result(P.prefix_trie(table(spark, one, 1))) == brute(conversations(one))
    turns = P.with_shared_heads(P.numbered(table(spark, one, 1)))
    assert result(P.trie(*turns)) == brute(rebuilt(conversations(one)))  # turnless once rebuilt


def test_running_values_go_on_over_tasks(spark):
    r = random.Random(3)
    rows = [(0 if k < 300 else k % 5, k, r.randrange(100), r.randrange(1 << 40)) for k in range(500)]
    df = spark.createDataFrame(rows, "key long, k long, plus long, flip long").repartition(7)
    got = P.running(df, "key", ["k"], {"plus": np.add, "flip": np.bitwise_xor}).collect()
    total, flipped = defaultdict(int), defaultdict(int)
    expected = {}
    for key, k, plus, flip in rows:
        total[key] += plus
        flipped[key] ^= flip
        expected[k] = (key, total[key], flipped[key])
    assert {x.k: (x.key, x.plus, x.flip) for x in got} == expected


def test_slots_are_minimal_and_checked():
    r = np.random.default_rng(5)
    x, y = r.integers(-(1 << 62), 1 << 62, 5000), r.integers(-(1 << 62), 1 << 62, 5000)
    x[:100] = x[0]  # one half alone does not tell them apart
    slots = P.Slots(x, y)
    assert sorted(slots.slot) == list(range(5000)) and (slots.find(x, y) == slots.slot).all()
    assert (slots.find(x, y + 1) == -1).all() and len(P.Slots(x[:0], y[:0]).find(x, y)) == 5000
    with pytest.raises(ValueError):
        P.Slots(x[[0, 0]], y[[0, 0]])


def test_other_seeds_after_a_collision(spark, monkeypatch):
    """The first digests are made to collide."""
    plain, tried = P._digests, []

    def digests(rows, seed):
        tried.append(seed)
        return plain(rows, seed) if seed else plain(rows, seed).selectExpr("conv", "at", "a", "b", "size", "after", "x % 3 AS x", "0L AS y", "px", "py")

    monkeypatch.setattr(P, "_digests", digests)
    rows = sample(1)[:60]
    assert result(P.prefix_trie(table(spark, rows))) == brute(conversations(rows)) and tried == [0, 1]
