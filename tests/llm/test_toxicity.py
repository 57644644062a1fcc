import zlib

import numpy as np
import pyspark.sql.functions as F
import pytest

from tallyforge.llm import toxicity
from tallyforge.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = QUERIES["op7_toxicity"](spark, FOLDER).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic = [p for y, p in held if y == 1]
    assert np.mean([y == p for y, p in held]) >= 0.97
    assert np.mean(toxic) >= 0.8  # about a tenth of the toxic labels mark texts without a toxic word
    assert np.mean([p for y, p in held if y == 0]) <= 0.01


def test_long_text_scores_as_in_parts(monkeypatch):
    r = np.random.default_rng(0)
    texts = [r.integers(0, 1 << 63, (n, 1 + len(toxicity.PREFIXES))).astype(np.uint64) for n in (0, 1, 2, 3, 50, 400)]
    model = toxicity.Model()
    row = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = model.pooled(model.buckets(np.concatenate(texts)), row)
    monkeypatch.setattr(toxicity, "_BLOCK_WORDS", 7)
    assert np.allclose(whole, model.pooled(model.buckets(np.concatenate(texts)), row), atol=1e-5)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, None, 5), (2, "", 5), (None, "idiot " * 200_000, 5), (3, "ok", 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(2, None), (3, 1), (3, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    with pytest.raises(ValueError):
        toxicity.score(docs, model)
    rows = toxicity.score(docs, model, prefix="x_").collect()
    assert len(rows) == 5 and all(0 <= r.x_score <= 1 for r in rows)
    assert toxicity.score(docs.limit(0), model, prefix="x_").count() == 0
    empty = toxicity.fit(docs, labels.limit(0))
    assert {r.x_score for r in toxicity.score(docs, empty, prefix="x_").collect()} == {0.5}


def test_text_over_the_word_bound_is_passed_over_alone(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 1000)
    keys = [k for k in range(200) if zlib.crc32(str(k).encode()) % 5]
    rows = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    order = [r.doc_id for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    docs = spark.createDataFrame([(k, "word " * (1001 if k == order[0] else 5)) for k in keys], "doc_id long, text string")
    taught = {}
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, languages: taught.update(sizes=sorted(map(len, texts))))
    toxicity.fit(docs, rows.withColumn("toxic", F.lit(1)))
    assert taught["sizes"] == [5] * (len(keys) - 1)


def test_training_in_a_task_gives_the_same_model(spark, monkeypatch):
    texts = {k: f"word{k % 7} some text {'ugly' if k % 3 == 0 else 'nice'} number {k % 5}" for k in range(120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in texts], "doc_id long, toxic int")
    here = toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "_of_sample", None)  # the driver does not train
    there = toxicity.fit(docs, labels, in_task=True)
    for name in ("embedding", "out", "floor"):
        np.testing.assert_allclose(getattr(there, name), getattr(here, name), atol=1e-4)
    assert there.trained and not toxicity.fit(docs, labels.limit(0), in_task=True).trained
