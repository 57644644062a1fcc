"""One query per operator over the given tables, with the SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from tallyforge.session import scratch_path

from . import ann, bpe_codec, decontaminate, hard_negatives, license_scan, ngram_join, prefix_trie, substring_dedup, token_count, token_store, toxicity, url_filter, warc

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document inside benchmark windows, and the verdict."""
    return decontaminate.contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"), keep=["doc_id"]
    ).drop("items")


@_query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text by the multilingual ranks, and back."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_codec.digests(bpe_codec.encode(_table(spark, folder, "documents"), path, keep=["doc_id"]), path)


@_query("op4_token_store")
def op4_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text written to shards, and what is read back from them."""
    out = scratch_path(spark, "token-store")
    token_store.write_ids(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), out)
    return token_store.read_ids(spark, out).drop("ids")


@_query("op9_token_counts")
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_count.token_counts(_table(spark, folder, "documents"), path, keep=["doc_id"])


@_query(
    "op2_warc",
    """
    WITH sized AS (
        SELECT page_id, coalesce(html, '') AS payload FROM pages
    ), firsts AS (
        SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM sized
    ), bits AS (
        SELECT page_id, first, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM firsts
    ), numbers AS (
        SELECT *, list_transform(range(0, 32), lambda k: list_sum(list_transform(range(0, 5), lambda b:
            (((strpos('0123456789abcdef', substr(hex, ((5 * k + b) // 4 + 1)::INT, 1)) - 1) >> (3 - (5 * k + b) % 4)::INT) & 1) << (4 - b)::INT))) AS fives
        FROM bits
    )
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
        array_to_string(list_transform(fives, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v::INT + 1, 1)), '') AS payload_digest,
        CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id > first THEN first END AS refers_to
    FROM numbers
    """,
)
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back from them."""
    archives = warc.write_archives(_table(spark, folder, "pages"), scratch_path(spark, "warc"))
    return warc.read_archives(spark, archives, payloads=False).drop("url", "payload")


#: Fixed rules of the query: host, path, action.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@_query(
    "op5_url_filter",
    """
    WITH rules(rule_host, rule_path, action) AS (
        VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
            ('net', '/es/', 'block'), ('net', '/fr/', 'block')
    ), rests AS (
        SELECT row_number() OVER () AS k, page_id,
            CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), parts AS (
        SELECT k, page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM rests
    )
    SELECT any_value(page_id) AS page_id, any_value(host) AS host, any_value(path) AS path,
        arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        coalesce(arg_max(action, length(rule_host || rule_path)), 'allow') AS verdict
    FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY k
    """,
)
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(_table(spark, folder, "pages"), rules)


@_query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score and prediction of every document by a model trained outside fold 0."""
    docs = _table(spark, folder, "documents")
    model = toxicity.fit(docs, _table(spark, folder, "labels"))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (toxicity.fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


@_query("op6_nearest")
def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest found for every vector whose id is divisible by 50."""
    return ann.nearest(_table(spark, folder, "embeddings"))


@_query("op10_ngram_join")
def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 4-word shingles are at least 0.85 similar."""
    return ngram_join.linked(_table(spark, folder, "documents"), shingle=4, above=85)


@_query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the passages that earlier documents hold, and which those are."""
    found = substring_dedup.deduplicated(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_in", "text")


@_query(
    "op11_hard_negatives",
    """
    WITH base AS (
        SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), scores AS (
        SELECT a.k, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
        FROM base a JOIN base b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
    ), positives AS (
        SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.vec_id AS positive_id,
        (row_number() OVER (PARTITION BY p.k, p.vec_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
        n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scores n ON n.k = p.k AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    QUALIFY rank <= 3
    """,
)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Negatives whose score lies close below that of each anchor's positives."""
    vectors = _table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label))


@_query(
    "op12_prefix_trie",
    """
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), heads AS (
        SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))
        ), 4294967295::BIGINT) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM turns)
    ), rebuilt AS (
        SELECT heads.conv_id, 0 AS part, place, role, text FROM heads JOIN turns ON turns.conv_id = base AND place < h
        UNION ALL SELECT conv_id, 1, place, role, text FROM heads JOIN turns USING (conv_id) WHERE place >= h
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS d FROM rebuilt
    ), paths AS (
        SELECT conv_id, d, strlen(text) AS size,
            string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY d) AS path
        FROM placed
        UNION ALL SELECT conv_id, 0, 0, '' FROM heads
    ), linked AS (
        SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY d) AS above, lead(d) OVER (PARTITION BY conv_id ORDER BY d) IS NULL AS ends FROM paths
    ), nodes AS (
        SELECT d, path, any_value(above) AS above, min(conv_id) AS conv, count(*) AS n, (count(*) - 1) * any_value(size) AS saved,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM linked GROUP BY d, path
    ), kids AS (
        SELECT d - 1 AS d, above AS path, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL
    ), full_nodes AS (
        SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (d, path)
    ), sums AS (
        SELECT m.d, m.path, sum(CASE WHEN y.kids = 0 THEN 1 ELSE 0 END) AS leaves, sum(y.saved) AS saved
        FROM linked m JOIN full_nodes y ON y.conv = m.conv_id AND y.d >= m.d GROUP BY m.d, m.path
    )
    SELECT n.conv AS conv_id, n.d::BIGINT AS depth, p.conv AS parent_conv_id, n.n::BIGINT AS n_convs, n.kids::BIGINT AS n_children,
        s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
    FROM full_nodes n JOIN sums s USING (d, path) LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.path = n.above
    """,
)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each rebuilt on the head of another."""
    rows = prefix_trie.numbered(_table(spark, folder, "conversations"))
    return prefix_trie.trie(*prefix_trie.with_shared_heads(rows))


#: Fixed phrases of the query.
LICENSE_PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Fixed texts: versions as they are usually named, and the wording of common licences.
LICENSE_TEXTS = [
    ("gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"),
    ("apache license version 2 0", "apache-2"),
    ("cc by nc 4 0", "cc-by-nc-4"),
    ("cc by sa 4 0", "cc-by-sa-4"),
    ("cc by nd 4 0", "cc-by-nd-4"),
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so",
        "mit",
    ),
    (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer",
        "bsd",
    ),
    (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
        "gpl",
    ),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
]


@_query("op13_license_scan")
def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Places of licence phrases in every document, and licences told from their wording."""
    return license_scan.scan(_table(spark, folder, "documents"), LICENSE_PHRASES, LICENSE_TEXTS, keep=["doc_id"]).drop("found")
