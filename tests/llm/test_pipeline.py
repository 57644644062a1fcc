import hashlib
import zlib

import corpus_pipeline
from tallyforge.llm import ngram_join


def test_stages_on_given_table(spark, tmp_path):
    """Every stage keeps the columns, later stages work on what earlier ones kept, and the last
    describes exactly the texts that are left."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        kept = {r.doc_id for r in docs.collect()}
        assert kept <= ids and len(kept) == docs.count()
        ids = kept
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()}
    assert last.keys() == ids
    for r in docs.collect():
        assert last[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_no_training_text_keeps_all(spark, tmp_path):
    """Labels that are missing, null, held out or of no document."""
    docs = spark.createDataFrame([(k, f"some text {k}") for k in range(20)], "doc_id long, text string")
    held = next(k for k in range(20) if zlib.crc32(str(k).encode()) % 5 == 0)
    for n, rows in enumerate(([], [(1, None)], [(held, 1)], [(999, 1)])):
        spark.createDataFrame(rows, "doc_id long, toxic int").write.parquet(f"{tmp_path}/{n}/labels.parquet")
        assert corpus_pipeline.without_toxic(spark, docs, f"{tmp_path}/{n}").count() == 20


def test_copies_are_decided_by_row(spark, monkeypatch):
    """Repeated rows, ids with two texts, null ids."""
    words = lambda n: " ".join(f"w{n}x{k}" for k in range(60))
    a, b, c, d = map(words, range(4))
    near = a + " tail"
    rows = [(3, a), (3, a), (4, near), (5, near), (5, b), (6, c), (6, c), (None, c), (None, d), (None, d), (7, ""), (7, ""), (8, None)]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n long").repartition(3)
    expected = [(3, a), (5, b), (6, c), (7, ""), (7, ""), (8, None), (None, d)]
    for limit in (ngram_join.BROADCAST_ROWS, -1):
        monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", limit)
        found = corpus_pipeline.without_copies(spark, df, "")
        assert found.columns == df.columns
        assert sorted([(r.doc_id, r.text) for r in found.collect()], key=repr) == sorted(expected, key=repr)
    assert corpus_pipeline.without_copies(spark, df.limit(0), "").count() == 0
