"""Columns of the input that are called like the operators' own."""

import public_tokenizers

from tallyforge.llm import bpe_codec, decontaminate, token_count, toxicity


def test_own_names_may_be_there(spark):
    names = ("tf_text", "TF_text_", "tf_source", "tf_hits", "tf_items", "tf_words", "tf_decoded", "ids")
    docs = spark.createDataFrame([(1, "a b c", *names), (2, None, *names)], "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    items = spark.createDataFrame([("i", "b c")], "item_id string, text string")
    marks = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    path, merges = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe_codec.encode(docs, path, into="codes")
    results = [
        toxicity.score(docs, model), token_count.token_counts(docs, merges), decontaminate.contamination(docs, items, window=2),
        encoded, bpe_codec.digests(encoded, path, "codes"),
    ]
    for df in results:
        got = df.orderBy("doc_id").collect()
        assert [r.doc_id for r in got] == [1, 2] and all(r[c] == c for r in got for c in names)
    assert results[2].where("contaminated").count() == 1
