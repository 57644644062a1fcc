"""Licence scans against plain word loops."""

import random
import re

import pytest

from tallyforge.llm import license_scan as L
from tallyforge.llm.queries import LICENSE_PHRASES, LICENSE_TEXTS, op13_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = ("n_words", "n_base", "first_word", "last_word", "base_labels")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text, phrases=LICENSE_PHRASES):
    words, places, labels = words_of(text), [], set()
    for phrase, label in phrases:
        own = words_of(phrase)
        for k in range(len(words) - len(own) + 1):
            if words[k : k + len(own)] == own:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        out = [0]
        for j, y in enumerate(b):
            out.append(row[j] + 1 if x == y else max(row[j + 1], out[-1]))
        row = out
    return row[-1]


def docs_of(spark, texts, parts=3):
    return spark.createDataFrame([(k, t, "x", "y", "z") for k, t in enumerate(texts)], "doc_id long, text string, copy string, tf_text string, place string").repartition(parts)


@pytest.mark.parametrize("few,seen", [(500_000, 200_000), (-1, 1)])
def test_base_like_plain_loops(spark, monkeypatch, few, seen):
    monkeypatch.setattr(L, "BROADCAST_ROWS", few)
    monkeypatch.setattr(L, "SEEN", seen)
    r = random.Random(7)
    bag = "GNU general public license Apache cc by MIT the a-b nc 4 0 version é".split()
    texts = [" ".join(r.choice(bag) for _ in range(r.randrange(40))) for _ in range(200)]
    texts += [None, "", " ", "cc", "CC-BY", "cc by " * 5000, "mit\nlicense", "MIT License"] + ["the mit license, cc by"] * 60
    texts += ["x cc", "by y"]  # a phrase never spans two texts
    got = {row.doc_id: row for row in L.scan(docs_of(spark, texts), LICENSE_PHRASES, LICENSE_TEXTS).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        assert tuple(got[k][c] for c in BASE) == base(text), text
        assert set(filter(None, got[k].base_labels.split(","))) <= set(got[k].labels.split(","))
        assert got[k].score == (1.0 if got[k].found else 0.0) and (got[k].copy, got[k].tf_text, got[k].place) == ("x", "y", "z")


def test_wording_with_changes(spark):
    """Words added, left out and exchanged; too many changes are no licence."""
    r = random.Random(8)
    own = words_of(LICENSE_TEXTS[6][0])
    noise = lambda n: [f"w{r.randrange(500)}" for _ in range(n)]
    changed = own[:20] + own[23:40] + ["extra", "words"] + own[40:]
    swapped = [w if k % 7 else "other" for k, w in enumerate(own)]
    broken = [w if k % 3 else "other" for k, w in enumerate(own)]
    texts = [" ".join(noise(50) + body + noise(30)) for body in (own, changed, swapped, broken, own[:30], own + noise(100) + changed)]
    rows = L.scan(docs_of(spark, texts), [], LICENSE_TEXTS).orderBy("doc_id").collect()
    assert [row.labels for row in rows] == ["mit", "mit", "mit", "", "", "mit"]
    assert [len(row.found) for row in rows] == [1, 1, 1, 0, 0, 2]
    assert rows[0].score == 1.0 and rows[1].score == (len(own) - 3) / len(own) and rows[0].found[0].first == 50
    assert rows[2].score == common(own, swapped) / len(own)


def test_coverage_is_the_longest_common_subsequence():
    r = random.Random(9)
    for _ in range(50):
        own, other = ([r.choice("abcd") for _ in range(r.randrange(1, 90))] for _ in range(2))
        got = L.Templates([], [(" ".join(own), "x")]).coverage(0, [w.encode() for w in other])
        assert got == common(own, other) / len(own)


def test_versions_and_labels(spark):
    texts = ["Licensed under CC BY-NC 4.0", "the GNU General Public License, version 3", "gnu general public license version 4", "Apache License, Version 2.0."]
    rows = L.scan(docs_of(spark, texts), LICENSE_PHRASES, LICENSE_TEXTS).orderBy("doc_id").collect()
    assert [row.labels for row in rows] == ["cc-by,cc-by-nc-4", "gpl,gpl-3", "gpl", "apache,apache-2"]
    assert [row.base_labels for row in rows] == ["cc-by", "gpl", "gpl", "apache"]


def test_empty_tables_and_names(spark):
    docs = docs_of(spark, ["a mit license"])
    assert L.scan(docs.limit(0), LICENSE_PHRASES, LICENSE_TEXTS).count() == 0
    row = L.scan(docs, [], []).first()
    assert (row.n_words, row.n_base, row.labels, row.score, row.found) == (3, 0, "", 0.0, [])
    same = L.scan(docs, [("mit license", "a"), ("mit license", "b"), ("!", "c")]).first()
    assert (same.n_base, same.base_labels) == (2, "a,b")
    with pytest.raises(ValueError):
        L.scan(docs.withColumn("score", docs.doc_id), LICENSE_PHRASES)


def test_query_on_the_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op13_license_scan(spark, folder).collect()
    assert len(got) == len(texts)
    for row in got:
        assert tuple(row[c] for c in BASE) == base(texts[row.doc_id])
