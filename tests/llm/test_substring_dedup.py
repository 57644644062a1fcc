import itertools
import random

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest

from tallyforge.llm import substring_dedup
from tallyforge.llm.queries import QUERIES
from tallyforge.llm.textops import SPACED, Words


def words(r, n):
    return " ".join(f"v{r.randrange(10**7)}" for _ in range(n))


def test_planted_passages(spark):
    r = random.Random(6)
    passages = [words(r, n) for n in (51, 47, 60, 120, 400)]
    near = passages[3].split()
    near[40] = "changed"
    near[90:91] = []
    docs, holders = [], {}
    for k in range(60):
        parts = [words(r, r.randrange(5, 200))]
        if k % 2 == 0:
            p = (k // 2) % 6
            parts += [" ".join(near) if p == 5 else passages[p], words(r, r.randrange(0, 90))]
            holders.setdefault(3 if p == 5 else p, []).append(k)
        docs.append((k, r.choice([" ", "\n"]).join(parts)))
    line = words(r, 20)
    docs += [(100 + k, line + "\n" + words(r, 30) + "\n" + line) for k in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {x.doc_id: x for x in substring_dedup.deduplicated(df).collect()}
    texts = dict(docs)
    firsts = {p: min(h) for p, h in holders.items()}
    for k, x in found.items():
        own = next((p for p, h in holders.items() if k in h), None)
        if own is None or k == firsts[own]:
            assert (x.text, x.n_removed, x.kept_in) == (texts[k], 0, [])
        else:
            assert x.n_removed >= 32 and x.kept_in[0] == firsts[own] and set(x.kept_in) <= set(holders[own])
            assert x.n_removed + len(x.text.split()) == x.n_words == len(texts[k].split())
            assert passages[own] not in x.text
    assert {x.n_words - len(x.text.split()) > 0 for k, x in found.items() if k >= 100} == {False}


def test_every_shared_run_is_found(spark):
    """Against brute force on the given table: a run of REACH words in an earlier document."""
    folder, reach = "/root/testdata/sf0.001", substring_dedup.REACH
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    found = {x.doc_id: x for x in QUERIES["op8_substring_dedup"](spark, folder).collect()}
    assert len(found) == len(docs)
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).split()
    seen, small, hits = set(), set(), 0
    for doc, text in docs:
        own = lower(text)
        runs = {tuple(own[k : k + reach]) for k in range(len(own) - reach + 1)}
        if runs & seen:
            hits += 1
            assert found[doc].n_removed >= 32
        shingles = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
        if not shingles & small:
            assert found[doc].n_removed == 0 and found[doc].text == text
        seen |= runs
        small |= shingles
    assert hits


def test_odd_rows(spark):
    r = random.Random(1)
    p = words(r, 80)
    rows = [(1, None), (2, ""), (3, p), (3, p), (4, p + " tail"), (None, p), (5, "one two"), (6, " \n" + p.upper()), (7, words(r, 100_000) + " " + p), (7, "other text")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_words int").repartition(3)
    with pytest.raises(ValueError):
        substring_dedup.deduplicated(df)
    found = substring_dedup.deduplicated(df, prefix="x_").collect()
    gone = sorted((x.doc_id or 0, x.x_n_removed > 0, x.x_kept_in) for x in found)
    assert gone == [(0, False, []), (1, False, []), (2, False, []), (3, False, []), (3, False, []), (4, True, [3]), (5, False, []), (6, True, [3]), (7, False, []), (7, True, [3])]
    assert substring_dedup.deduplicated(df.limit(0), prefix="x_").count() == 0


def template_documents(r, n):
    """Texts that share a template below the threshold, each with a near copy further on."""
    template = words(r, 60).split()
    docs = {}
    for k in range(n):
        own = [w if r.random() > 0.04 else f"o{r.randrange(10**7)}" for w in template] if k % 2 else words(r, 60).split()
        near = own[:]
        near[r.randrange(60)] = "changed"
        docs[k], docs[1000 + k] = " ".join(own), " ".join(near)
    return docs


def brute_force(docs, colliding):
    """(doc, at) of the paragraphs to be cut, over all pairs of different documents, or those
    with a band in common."""
    units, contents = [], {}
    for doc, text in docs.items():
        raw = np.frombuffer(text.encode(), np.uint8)
        found = substring_dedup.Paragraphs(Words(raw, np.array([0, len(raw)]), SPACED))
        for k, at in enumerate(found.at.tolist()):
            shingles = frozenset(found.shingles[at : at + substring_dedup.PARAGRAPH - substring_dedup.SHINGLE + 1].tolist())
            units.append((doc, at, int(found.content[k]), shingles, found.keys[:, k]))
            contents.setdefault(int(found.content[k]), units[-1])
    root = {c: c for c in contents}

    def top(c):
        while root[c] != c:
            c = root[c]
        return c

    holders = {}
    for u in units:
        holders.setdefault(u[2], set()).add(u[0])
    by_shingle = {}
    for x in contents.values():
        for h in x[3]:
            by_shingle.setdefault(h, []).append(x)
    met = {(x[2], y[2]): (x, y) for group in by_shingle.values() for x, y in itertools.combinations(group, 2)}
    for x, y in met.values():
        common = len(x[3] & y[3])
        if common >= 0.8 * (len(x[3]) + len(y[3]) - common) and len(holders[x[2]] | holders[y[2]]) > 1 and (not colliding or (x[4] == y[4]).any()):
            root[top(x[2])] = top(y[2])
    first = {}
    for doc, _, c, *_ in units:
        first[top(c)] = min(first.get(top(c), doc), doc)
    return {(doc, at) for doc, at, c, *_ in units if doc != first[top(c)]}


def test_members_of_a_bucket_meet(spark):
    """Near copies whose bucket has an unlike paragraph as its first holder."""
    docs = template_documents(random.Random(11), 150)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    found = {(x.doc, x["at"]) for x in substring_dedup.repeated(df, "doc_id", "text").collect()}
    assert found == brute_force(docs, colliding=True)


def test_recall_of_near_copies():
    """Near copies of 49 words without a shared paragraph, against brute force over all pairs;
    ``repeated`` finds what collides, as the test above says."""
    r = random.Random(12)
    docs = {}
    for k in range(1800):
        own = words(r, 49).split()
        near = own[:]
        near[31 if k % 2 else 17] = "changed"
        docs[k], docs[10_000 + k] = " ".join(own), " ".join(near)
    found, wanted = brute_force(docs, colliding=True), brute_force(docs, colliding=False)
    assert len(wanted) > 200 and found <= wanted and len(found) >= 0.99 * len(wanted)


def test_tiles_of_a_hot_bucket_lose_no_pair(spark, monkeypatch):
    rows = []
    for bucket, count in ((8, 40), (16, 7), (24, 2), (32, 1)):
        for k in range(count):
            sketch = [(1 << (k % 50)) - 1, k % 3, 0, 0]
            rows.append((bucket, 1000 * bucket + k * 37 % 101, k % 5, k % 5 + k % 2, k // 4, 20 + k % 4, *sketch, count))
    names = "bucket bigint, content bigint, low bigint, high bigint, label bigint, n int, s0 bigint, s1 bigint, s2 bigint, s3 bigint, size bigint"
    members = spark.createDataFrame(rows, names)
    expected = []
    for a in rows:
        for b in rows:
            if a[0] != b[0] or a[1] >= b[1] or a[4] == b[4] or min(a[2], b[2]) == max(a[3], b[3]):
                continue
            apart = sum((x ^ y).bit_count() for x, y in zip(a[6:10], b[6:10]))
            if apart * 1.8 <= (a[5] + b[5]) * 0.2 + 1e-6:
                expected.append((a[1], b[1]))
    assert len(expected) > 50
    for tile in (1, 3, 1024):
        monkeypatch.setattr(substring_dedup, "TILE", tile)
        assert sorted(map(tuple, substring_dedup._member_pairs(members, 0.8).collect())) == sorted(expected)


def test_blocks_of_hot_buckets_lose_no_link(spark, monkeypatch):
    """As ``test_members_of_a_bucket_meet``, with every open bucket compared in small blocks."""
    monkeypatch.setattr(substring_dedup, "DENSE", 1)
    monkeypatch.setattr(substring_dedup, "BLOCK", 8)
    docs = template_documents(random.Random(11), 150)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    found = {(x.doc, x["at"]) for x in substring_dedup.repeated(df, "doc_id", "text").collect()}
    assert found == brute_force(docs, colliding=True)


def test_slices_of_open_buckets_lose_no_link(spark, monkeypatch):
    """As ``test_members_of_a_bucket_meet``: no slice holds all open buckets."""
    seen, finer = [], substring_dedup._finer

    def counted(members, *rest):
        seen.append(members.count())
        return finer(members, *rest)

    monkeypatch.setattr(substring_dedup, "_finer", counted)
    monkeypatch.setattr(substring_dedup, "SLICE_ROWS", 1, raising=False)
    monkeypatch.setattr(substring_dedup, "SLICES", 3, raising=False)
    docs = template_documents(random.Random(11), 150)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    found = {(x.doc, x["at"]) for x in substring_dedup.repeated(df, "doc_id", "text").collect()}
    assert found == brute_force(docs, colliding=True)
    assert len(seen) == 3 and max(seen) < 0.7 * sum(seen)


def test_blocks_make_no_more_rows_than_members():
    """A group of near copies has links by the square of its size; a block gives a forest."""
    r, n, rows = random.Random(3), 60, []
    base = [r.randrange(1 << 62) for _ in range(28)]
    for k in range(n):
        own = np.unique(np.array([*base[:26], k * 1000 + 1, k * 1000 + 2], np.uint64))
        rows.append((k * 37 % 101, k * 37 % 101, k, k, 0, len(own), *substring_dedup._sketch(own).tolist(), own.view(np.int64).tolist()))
    names = ["content", "label", "low", "high", "part", "n", *(f"s{k}" for k in range(substring_dedup.SKETCH_WORDS)), "s"]
    block = pa.table(dict(zip(names, map(list, zip(*rows)))))
    links = substring_dedup._forest(0.8)((pa.scalar(1), pa.scalar(0), pa.scalar(0)), block).to_pylist()
    assert len(links) == n - 1 and all(x["a"] < x["b"] for x in links)
    reached = {links[0]["a"]}
    for _ in range(n):
        reached |= {y for x in links for y in x.values() if reached & set(x.values())}
    assert len(reached) == n


def test_sketches_rule_pairs_out_before_shingles_are_sent(spark):
    r, sets = random.Random(4), []
    base = [r.randrange(1 << 62) for _ in range(28)]
    for k, shared in enumerate((28, 26, 20, 5, 0)):
        own = np.unique(np.array([*base[:shared], *(r.randrange(1 << 62) for _ in range(28 - shared))], np.uint64))
        sets.append((k, own.view(np.int64).tolist(), substring_dedup._sketch(own).tolist(), len(own)))
    sets = spark.createDataFrame(sets, "content bigint, s array<bigint>, sketch array<bigint>, n int")
    pairs = spark.createDataFrame([(0, k) for k in range(1, 5)], "a bigint, b bigint")
    assert [tuple(x) for x in substring_dedup._near(pairs, sets, 0.8).collect()] == [(0, 1)]
    assert [tuple(x) for x in substring_dedup._similar(pairs, sets, 0.8).collect()] == [(0, 1)]


def test_large_buckets_are_cut_by_rare_shingles(spark):
    """Members alike below the threshold make rows in proportion to their number and do not meet;
    similar ones do."""
    r, sets, members = random.Random(8), [], []
    base = [r.randrange(1 << 62) for _ in range(20)]
    for k in range(300):
        own = base + [r.randrange(1 << 62) for _ in range(8)]
        for copy in range(2 if k % 10 == 0 else 1):
            own = [*own[:26], *(r.randrange(1 << 62) for _ in range(2))]
            content = 2 * k + copy
            sets.append((content, own, len(own)))
            members.append((7, content, content, content, content))
    sets = spark.createDataFrame(sets, "content bigint, s array<bigint>, n int")
    rare = substring_dedup._rare(sets, 0.8)
    assert rare.count() == 6 * len(members)
    members = spark.createDataFrame(members, "bucket bigint, content bigint, low bigint, high bigint, label bigint")
    found = substring_dedup._finer(members, sets, 0.8).groupBy("bucket").agg(F.collect_set("content").alias("c")).collect()
    met = {tuple(sorted(x.c)) for x in found}
    assert met <= {(20 * k, 20 * k + 1) for k in range(30)} and len(met) == 30


def test_few_rows_of_long_lists_are_not_broadcast(spark, monkeypatch):
    """The driver holds what is broadcast: its bytes are bounded, not its rows alone."""
    def broadcast(df):
        return "broadcast" in substring_dedup._bounded(df)._jdf.queryExecution().logical().toString()

    narrow = spark.range(300).selectExpr("id as content", "id as passage")
    wide = spark.range(300).select(F.col("id").alias("doc"), F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda x: F.struct(x.alias("at"), (x + F.col("id")).alias("content"))).alias("spans"))
    assert broadcast(narrow) and broadcast(wide.limit(3)) and broadcast(narrow.limit(0))
    assert not broadcast(wide)
    monkeypatch.setattr(substring_dedup, "BROADCAST_ROWS", 299)
    assert not broadcast(narrow)


def test_shuffled_joins_find_the_same(spark, monkeypatch):
    r = random.Random(12)
    passage = words(r, 120)
    rows = [(k, words(r, 40) + " " + passage + " " + words(r, 60)) for k in range(12)] + [(None, passage), (None, None), (3, passage), (50, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    small = sorted(map(str, substring_dedup.deduplicated(df).collect()))
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", 0)
    assert sorted(map(str, substring_dedup.deduplicated(df).collect())) == small and sum("kept_in=[0]" in x for x in small) == 12
