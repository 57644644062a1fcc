import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallyforge.llm import bpe_codec, token_count, token_store, vocab
from tallyforge.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts():
    r = random.Random(3)
    letters = "aab bcé ñ\n\t  \x1c'12 .,ΣσİǅÁͅ ﬁ漢字🙂\x00"
    out = ["", " ", "  \n ", "a" * 5000, "ab" * 3000, "<|endoftext|>", "x<|endoftext|> y  <|endoftext|>", "<|startoftext|>", "It's we'LL  'd"]
    return out + ["".join(r.choice(letters) for _ in range(r.randint(1, 200))) for _ in range(300)]


def reference_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.rank_file(vocab.read_file(RANKS)), special_tokens={})


def all_texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def test_codec_equals_library(spark):
    library = reference_encoding()
    found = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, FOLDER).collect()}
    docs = all_texts(spark)
    assert len(found) == len(docs)
    for doc, text in docs:
        ids = library.encode_ordinary(text or "")
        assert found[doc].n_tokens == len(ids)
        assert found[doc].ids_sha256 == hashlib.sha256(u32(ids)).hexdigest()
        assert found[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_codec_odd_texts(spark):
    library, texts = reference_encoding(), odd_texts()
    df = spark.createDataFrame([(k, t, t) for k, t in enumerate(texts)] + [(None, None, None), (1, " ", " ")], "doc_id long, text string, decoded string")
    encoded = bpe_codec.encode(df, RANKS)
    for r in encoded.where("doc_id is not null").collect():
        assert bytes(r.ids) == u32(library.encode_ordinary(texts[r.doc_id])), texts[r.doc_id]
    back = bpe_codec.decode(encoded, RANKS, into="bytes_again").collect()
    assert len(back) == len(texts) + 2
    assert all(bytes(r.bytes_again) == (r.text or "").encode() for r in back)
    with pytest.raises(ValueError):
        bpe_codec.decode(encoded, RANKS)
    assert bpe_codec.digests(bpe_codec.encode(df.limit(0), RANKS), RANKS).count() == 0


def test_long_piece():
    codec = bpe_codec.ByteBpe(vocab.rank_file(vocab.read_file(RANKS)))
    piece = "".join(random.Random(1).choice("abcdefgh") for _ in range(200_000))
    assert codec.decode(codec.encode(piece)) == piece.encode()
    counter = token_count.MergeCounter(vocab.read_file(BYTES))
    assert counter.text(piece) == len(Tokenizer.from_file(BYTES).encode(piece, add_special_tokens=False).ids)


def test_counts_equal_library(spark):
    library = Tokenizer.from_file(BYTES)
    docs = all_texts(spark)
    found = {r.doc_id: r for r in QUERIES["op9_token_counts"](spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for doc, text in docs:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[doc].n_bytes, found[doc].n_tokens, found[doc].over_limit) == (len((text or "").encode()), n, n > 512)


def test_counts_odd_texts(spark):
    library, texts = Tokenizer.from_file(BYTES), odd_texts()
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(-1, None), (-1, None)], "n_tokens long, text string")
    with pytest.raises(ValueError):
        token_count.token_counts(df, BYTES)
    rows = token_count.token_counts(df, BYTES, prefix="x_").collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        assert r.x_n_tokens == (len(library.encode(r.text, add_special_tokens=False).ids) if r.text else 0), r.text
    assert token_count.token_counts(df.limit(0), BYTES, prefix="x_").count() == 0


def expected_store(docs):
    library, start, out = Tokenizer.from_file(WORDS), 0, []
    for doc, text in docs:
        ids = u32(library.encode(text or "", add_special_tokens=False).ids + [2])
        out.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def test_store_equals_library(spark):
    rows = QUERIES["op4_token_store"](spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, rows)) == expected_store(sorted(all_texts(spark)))


def test_store_encoder_equals_library_on_random_texts():
    rng, library = random.Random(5), Tokenizer.from_file(WORDS)
    encoder = token_store.LibraryEncoder(vocab.read_file(WORDS))
    signs = list("aBzÉßÀ×÷ÿªµº'strevmld9٣éǅΣİıſK<|>.,;!?\x00\t\r\x0b\x85\xa0\u2028\u3000漢한½ⅷﬁ \n")
    signs += ["\u0301", "\u0327", "\u0345", "\u200d", "👍🏽", "'re", "'LL", "can't", "<|startoftext|>", "<|endoftext|>", " déjà,", " mots"]
    for _ in range(20_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 30)))
        assert encoder.encode(text) == u32(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_store_odd_texts_and_single_documents(spark, tmp_path):
    texts = odd_texts()
    docs = [(7 * k - 30, t) for k, t in enumerate(texts)] + [(5000, None), (5000, None), (5001, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    shards = token_store.write_ids(df, WORDS, f"{tmp_path}/a")
    assert shards.count() > 1 and shards.agg({"n_docs": "sum"}).first()[0] == len(docs)
    rows = token_store.read_ids(spark, f"{tmp_path}/a").select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, rows)) == expected_store(sorted(docs, key=lambda d: d[0]))
    one = token_store.read_ids(spark, f"{tmp_path}/a", wanted=[docs[4][0]]).collect()
    assert [r.doc_id for r in one] == [docs[4][0]]
    first = shards.orderBy("shard").first()
    raw = open(first.path, "rb").read()
    import io

    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert len(whole) == 2 * first.n_tokens
    with open(first.path, "r+b") as file:
        file.seek(6)
        file.write(b"\x00\xff\x00")
    with pytest.raises(Exception):
        token_store.read_ids(spark, f"{tmp_path}/a").collect()
    assert token_store.write_ids(df.limit(0), WORDS, f"{tmp_path}/b").count() == 0
    assert token_store.read_ids(spark, f"{tmp_path}/b").count() == 0


def test_codec_holds_little(spark):
    """Large batches are worked on in parts, and the cache of pieces stays small."""
    from types import SimpleNamespace

    data = vocab.read_file(RANKS)
    texts = [f"line {k} of a text" for k in range(1201)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1202)), pa.array(texts)], names=["id", "text"])
    out = list(bpe_codec._encoder(SimpleNamespace(value=data), ["id"], ["id", "ids"], "text")(iter([batch])))
    assert [x.num_rows for x in out] == [500, 500, 202]
    back = list(bpe_codec._decoder(SimpleNamespace(value=data), ["id"], ["id", "text"], "ids")(iter(out)))
    assert [x.num_rows for x in back] == [500, 500, 202]
    assert [x.as_py().decode() for b in back for x in b.column("text")] == [x or "" for x in texts]
    assert [x.as_py() for b in back for x in b.column("id")] == list(range(1202))
    assert bpe_codec._codec(data).cache.limit <= 150_000


def test_short_pieces_merge_without_a_tree(monkeypatch):
    codec, rng = bpe_codec.ByteBpe(vocab.rank_file(vocab.read_file(RANKS))), random.Random(9)
    pieces = ["".join(rng.choice("aabcdeéß漢 ._") for _ in range(rng.randint(1, 20))).encode() for _ in range(3000)]
    expected = [codec._long(p) for p in pieces]
    monkeypatch.setattr(codec, "_long", None)
    assert [codec.merge(p) for p in pieces] == expected


def test_piece_cache_computes_each_piece_once():
    asked = []
    cache = vocab.PieceCache(lambda pieces: asked.extend(pieces) or [p.encode() for p in pieces], limit=3, longest=4)
    for pieces in (["a", "b", "a"], [], ["b", "longer", "longer", "c"], ["d", "a"], ["longer", "b"], ["e", "f", "g"]):
        assert cache.values(pieces) == [p.encode() for p in pieces]
    assert sorted(asked) == ["a", "b", "c", "d", "e", "f", "g", "longer", "longer"]
    assert "longer" not in cache.young and "longer" not in cache.old


def test_store_splits_typed_texts_without_library(monkeypatch):
    library = Tokenizer.from_file(WORDS)
    encoder = token_store.LibraryEncoder(vocab.read_file(WORDS))
    monkeypatch.setattr(encoder.chunks, "compute", None)
    for text in ("Été*** l'ÀME d'été, 2024!!\nit's $5.20 (x_y) <|end", "", " ", "'''sVE we'LL \n 'd"):
        assert encoder.encode(text) == u32(library.encode(text, add_special_tokens=False).ids), text


def test_store_words_are_merged_once():
    asked = []
    cache = token_store.MergedWords(lambda word: asked.append(word) or word.encode(), limit=3, longest=4)
    for words in (["a", "b", "a"], [], ["b", "longer", "c"], ["d", "a"], ["longer", "b"], ["e", "f", "g"]):
        assert cache.joined(words) == "".join(words).encode()
    assert sorted(asked) == ["a", "b", "c", "d", "e", "f", "g", "longer", "longer"]
    assert "longer" not in cache and "longer" not in cache.old and len(cache) <= 3
