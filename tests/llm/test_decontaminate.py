import hashlib
import random
import re

import pytest

from tallyforge.llm import decontaminate
from tallyforge.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    """docs and items: (id, text). One tuple per document in the query's column order."""
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        size = min(13, len(words))
        for a in range(len(words) - size + 1 if words and item is not None else 0):
            windows.setdefault(tuple(words[a : a + size]), set()).add(str(item))
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for a in range(len(words) - size + 1):
                if (names := windows.get(tuple(words[a : a + size]))) is not None:
                    found |= names
                    hit |= set(range(a, a + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def rows(df):
    names = "doc_id n_words n_hit n_items items_sha256 contaminated".split()
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()
    found = rows(QUERIES["op1_decontaminate"](spark, folder))
    assert found == brute(docs, items)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


@pytest.mark.parametrize("pass_bytes", [8 << 20, 60])
def test_small_vocabulary(spark, monkeypatch, pass_bytes):
    """Few different words: many overlapping hits, short items, several passes."""
    monkeypatch.setattr(decontaminate, "PASS_BYTES", pass_bytes)
    r = random.Random(5)
    text = lambda n: " ".join(r.choice(["a", "B", "Ça", "9"]) + r.choice(["", "", ",", "-"]) for _ in range(n))
    items = [(k, text(r.randint(1, 16))) for k in range(9)] + [(20, None), (21, ""), (None, "a a"), (22, "zz zz"), (23, "ZZ, zz")]
    docs = [(k, text(r.randint(0, 60))) for k in range(40)] + [(90, None), (91, ""), (None, "a zz zz"), (92, "zz"), (92, "zz")]
    left = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, body string, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(left, right, text="body", keep=["doc_id", "text"])
    assert rows(found) == brute(docs, items)


def test_long_text_and_empty_tables(spark):
    long = " ".join(f"w{k}" for k in range(400_000))
    planted = long + " one two three " + long
    docs = spark.createDataFrame([(1, planted), (2, "x" * 3_000_000)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "One two. THREE")], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.contamination(docs, items).collect()}
    assert (found[1].n_words, found[1].n_hit, found[1].n_items, found[1].contaminated) == (800_003, 3, 1, False)
    assert (found[2].n_words, found[2].n_hit) == (1, 0)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert {r.n_items for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 5)], "doc_id long, text string, n_words int")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    with pytest.raises(ValueError):
        decontaminate.contamination(docs, items)
    row = decontaminate.contamination(docs, items, prefix="x_").first()
    assert (row.n_words, row.x_n_words, row.x_n_hit) == (5, 2, 1)
