import random
import re

import numpy as np
import pytest

from tallyforge.llm import ngram_join
from tallyforge.llm.components import components
from tallyforge.llm.queries import QUERIES


def brute(docs, shingle, above, below=100):
    """{doc: (set size, component)} of (doc, text) with different docs."""
    sets = []
    for doc, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        found = {tuple(words[k : k + shingle]) for k in range(len(words) - shingle + 1)} or ({tuple(words)} if words else set())
        sets.append((doc, found))
    parent = {doc: doc for doc, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for doc, found in sets:
        for s in found:
            index.setdefault(s, []).append(doc)
    size, common = {doc: len(found) for doc, found in sets}, {}
    for members in index.values():
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    for (a, b), n in common.items():
        if below * n >= above * (size[a] + size[b] - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {doc: (size[doc], root(doc)) for doc, _ in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_given_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(docs, 4, 85)
    assert found(QUERIES["op10_ngram_join"](spark, folder)) == expected
    assert any(doc != c for doc, (_, c) in expected.items())


def edited(r, words, edits):
    words = list(words)
    for _ in range(edits):
        at = r.randrange(len(words))
        words[at : at + 1] = r.choice([[], [f"e{r.randrange(999)}"], [words[at], f"i{r.randrange(999)}"]])
    return words or ["x"]


@pytest.mark.parametrize("seed,shingle,above", [(1, 4, 85), (2, 2, 70)])
def test_families_near_the_threshold(spark, seed, shingle, above):
    """Chains of edits, many links just above or below."""
    r = random.Random(seed)
    texts = []
    for _ in range(12):
        base = [f"w{r.randrange(40 if r.random() < 0.3 else 5000)}" for _ in range(r.choice([2, 5, 8, 20, 60, 300]))]
        for _ in range(r.choice([1, 3, 12])):
            base = edited(r, base, r.choice([0, 1, 1, 2, len(base) // 30 + 1]))
            texts.append(" ".join(base))
    shared = " ".join(f"s{k}" for k in range(12))
    texts += [shared + " " + " ".join(f"u{k}x{j}" for j in range(5)) for k in range(30)]
    docs = [(7 * k + 1, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, set int").repartition(5)
    assert found(ngram_join.linked(df, shingle=shingle, above=above)) == brute(docs, shingle, above)


def test_no_similar_pair_without_a_common_key():
    r = random.Random(4)
    plan = ngram_join.Plan(85, 100, 4)
    for _ in range(400):
        a = np.array(r.sample(range(10**6), r.choice([1, 3, 6, 7, 12, 13, 40, 200, 900])), np.uint64)
        b = set(a.tolist())
        for _ in range(plan.difference(2 * len(a)) + 1):
            if r.random() < 0.5 and len(b) > 1:
                b.remove(r.choice(sorted(b)))
            else:
                b.add(r.randrange(10**6, 2 * 10**6))
        both = len(b & set(a.tolist()))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        b = np.array(sorted(b), np.uint64)
        common = np.intersect1d(plan.keys(np.sort(a)), plan.keys(b))
        assert len(common)
        needs = [dict(plan.needs(v)) for v in (np.sort(a), b)]
        band = plan.number(plan.upper(max(len(a), len(b))))
        assert 1 <= max(n[band] for n in needs) <= (common % np.uint64(1 << ngram_join.BAND_BITS) == band).sum()
        x, y = ngram_join.short_sketch(a), ngram_join.short_sketch(b)
        n = min(len(x), len(y))
        apart = np.bitwise_count(ngram_join.folded(x, n) ^ ngram_join.folded(y, n)).sum()
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))


def test_common_wording_makes_no_pairs_of_unlike_texts(spark, monkeypatch):
    """Long texts that share a quarter of their words agree in some blocks each. A fixed sketch
    does not tell such large sets apart, and every two of them were compared in each block."""
    r = random.Random(6)
    common = [f"c{r.randrange(10**6)}" for _ in range(350)]
    docs = [(k, " ".join([*common, *(f"u{r.randrange(10**8)}" for _ in range(1150))])) for k in range(1, 31)]
    docs += [(k + 100, edited(r, text.split(), 20)) for k, text in docs[:3]]
    docs = [(k, text if isinstance(text, str) else " ".join(text)) for k, text in docs]
    made, pairs = [], ngram_join._bucket_pairs

    def counted(members, plan):
        found = pairs(members, plan)
        made.append(found.count())
        return found

    monkeypatch.setattr(ngram_join, "_bucket_pairs", counted)
    rows = found(ngram_join.linked(spark.createDataFrame(docs, "doc_id long, text string"), shingle=5, above=80))
    assert rows == brute(docs, 5, 80) and sum(k != c for k, (_, c) in rows.items()) == 3
    assert sum(made) <= len(docs)


def test_odd_rows(spark):
    long = " ".join(str(k % 70_001) for k in range(300_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE\x0b"), (5, "ONE\x0b"), (6, "one two"), (None, "one two"), (None, "alone here"), (7, long), (8, long + " end"), (9, "x" * 2_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in ngram_join.linked(df).collect())
    assert got == [(-1, -1), (-1, 6), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (5, 4), (6, 6), (7, 7), (8, 7), (9, 9)]
    assert ngram_join.linked(df.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 200)] + [(1000, k) for k in range(1001, 1300)] + [(5000, 5000)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1300)}
