"""Token ids in binary shards that a reader opens at single documents.

A shard is a zstandard file in the public seekable format: one independent frame per document,
then a skippable frame with the documents' keys, then a skippable frame with the seek table
(compressed size, decompressed size and the low 32 bits of XXH64 of each frame). Any zstandard
tool decompresses the whole shard to the bare ids, 16 or 32 bits each. Shards follow the order
of the documents' ids; a Parquet table beside them lists them.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pyspark.sql.types as T
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from . import storage
from .vocab import PieceCache, byte_letters, packed, read_file

# Fixed values of the seekable format.
KEYS_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1

#: Printable ASCII and composed Latin-1 letters, each with one lower-case form, and the split of
#: such texts in lower case.
TYPED = re.compile("[ \n!-~À-ÖØ-öø-ÿ]*").fullmatch
MATCHES = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \na-zß-öø-ÿ0-9]+").findall
#: Bytes, read as Latin-1, to the letters that stand for them.
BYTE_LETTERS = {byte: letter for letter, byte in byte_letters().items()}

ROWS_PER_SHARD = 50_000
MOST_SHARDS = 20_000


class MergedWords(dict):
    """Ids of matches, merged one by one when they are met first: a match that is there costs one
    look-up. Two generations of up to ``limit`` entries; matches over ``longest`` characters are
    not kept."""

    def __init__(self, merge: Callable[[str], bytes], limit: int, longest: int = 200):
        super().__init__()
        self.merge, self.limit, self.longest = merge, limit, longest
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.merge(word)
            if len(word) > self.longest:
                return value
        self[word] = value
        return value

    def joined(self, words: list[str]) -> bytes:
        found = b"".join(map(self.__getitem__, words))
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        return found


class LibraryEncoder:
    """Ids by the tokenizers library, which merges each different match of these vocabularies'
    split once. Printable ASCII and Latin-1 letters need no library to be lower-cased and split.
    Other texts are cut at white space, which ends every match: each different chunk of them is
    normalised and split by the library once. What holds an added token goes through the library
    as it is. With another kind of split, ``whole`` sends whole texts."""

    def __init__(self, data: bytes, whole: bool = False):
        self.library = Tokenizer.from_str(data.decode())
        self.whole = whole
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.merge = self.library.model.tokenize
        self.words = MergedWords(self._word, limit=400_000)
        self.chunks = PieceCache(self._chunks, limit=150_000)
        self.matches = PieceCache(self._matches, limit=50_000)

    def _matches(self, matches: list[str]) -> list[bytes]:
        return [packed([t.id for t in self.merge(x)]) for x in matches]

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array("I", [t.id for t in self.merge(letters)]).tobytes()

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        normal, split = self.library.normalizer.normalize_str, self.library.pre_tokenizer.pre_tokenize_str
        found = []
        for chunk in chunks:
            if any(x in chunk for x in self.added):
                found.append(packed(self.library.encode(chunk, add_special_tokens=False).ids))
            elif TYPED(chunk):
                found.append(self.words.joined(MATCHES(chunk.lower())))
            else:
                found.append(b"".join(self.matches.values([x[0] for x in split(normal(chunk))])))
        return found

    def encode(self, text: str) -> bytes:
        if self.whole:
            return packed(self.library.encode(text, add_special_tokens=False).ids)
        if TYPED(text) and not any(x in text for x in self.added):
            return self.words.joined(MATCHES(text.lower()))
        return b"".join(self.chunks.values(text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def _library(data: bytes, whole: bool) -> LibraryEncoder:
    return LibraryEncoder(data, whole)


class ShardWriter:
    """Appends compressed frames to a shard; ``close`` writes keys and seek table."""

    def __init__(self, file):
        self.file, self.keys, self.table = file, [], []

    def add(self, key: int | None, frame: bytes, size: int, checksum: int) -> None:
        self.file.write(frame)
        self.keys.append(key)
        self.table.append((len(frame), size, checksum))

    def close(self, width: int) -> None:
        keys = pa.array(self.keys, pa.int64())
        batch = pa.RecordBatch.from_arrays([keys], names=["key"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(batch)
        body = sink.getvalue().to_pybytes() + struct.pack("<I", width)
        self.file.write(struct.pack("<II", KEYS_MAGIC, len(body)) + body)
        entries = np.array(self.table, "<u4").reshape(-1, 3).tobytes()
        footer = struct.pack("<IBI", len(self.table), 0x80, FOOTER_MAGIC)
        self.file.write(struct.pack("<II", SEEK_MAGIC, len(entries) + len(footer)) + entries + footer)


class ShardReader:
    """Keys and sizes of a shard from its end; single documents by their place."""

    def __init__(self, file, size: int):
        self.file = file
        file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != FOOTER_MAGIC or flags != 0x80:
            raise ValueError("no seek table with checksums at the end of the shard")
        start = size - 9 - 12 * count - 8
        file.seek(start)
        magic, length = struct.unpack("<II", file.read(8))
        if magic != SEEK_MAGIC or length != 12 * count + 9:
            raise ValueError("damaged seek table")
        self.table = np.frombuffer(file.read(12 * count), "<u4").reshape(-1, 3)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        file.seek(int(self.at[-1]))
        magic, length = struct.unpack("<II", file.read(8))
        if magic != KEYS_MAGIC:
            raise ValueError("no keys before the seek table")
        body = file.read(length)
        self.width = struct.unpack("<I", body[-4:])[0]
        self.keys = pa.ipc.open_stream(body[:-4]).read_all().column("key").to_pylist()
        self.zstd = zstandard.ZstdDecompressor()

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document; only its frame is read and decompressed."""
        self.file.seek(int(self.at[k]))
        data = self.zstd.decompress(self.file.read(int(self.table[k, 0])), max_output_size=int(self.table[k, 1]) or 1)
        if len(data) != self.table[k, 1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(data, f"<u{self.width}")


def write_ids(
    docs: DataFrame,
    path: str,
    folder: str,
    text: str = "text",
    key: str = "doc_id",
    end_id: int | None = 2,
    whole: bool = False,
    level: int = 3,
) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write all ids below ``folder`` in
    ascending order of ``key``. Returns the table of shards: shard, path, size, n_docs,
    n_tokens, start (ids in all shards before it).

    Null and empty texts hold the end id alone. Null keys come first. Rows with equal keys stay
    apart, ordered by their frames. No rows: no shards. Extra columns are not stored, so their
    names cannot clash. A text of any length is one frame.

    Documents are compressed where they are read; only frames are shuffled, once, by ranges of
    the key found beforehand from that column alone. A task whose executor is lost writes its
    shard again under a new name; only files named in the table count.
    """
    spark = docs.sparkSession
    storage.make_folder(folder)
    rows = docs.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, min(MOST_SHARDS, max(parts, -(-rows // ROWS_PER_SHARD))))
    edges = docs.where(F.col(key).isNotNull()).approxQuantile(key, [k / shards for k in range(1, shards)], 0.25 / shards) if rows else []
    bounds = np.unique(np.array(edges or [], np.float64)).astype(np.int64)
    data = read_file(path)
    shared = spark.sparkContext.broadcast((data, bounds))
    width = 2 if Tokenizer.from_str(data.decode()).get_vocab_size() <= 1 << 16 and (end_id or 0) < 1 << 16 else 4
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, bounds = shared.value
        library = _library(data, whole)
        zstd = zstandard.ZstdCompressor(level=level, write_checksum=False)
        for batch in batches:
            keys = batch.column(0)
            shard = [0 if k is None else int(np.searchsorted(bounds, k, "right")) for k in keys.to_pylist()]
            frames, sizes, sums = [], [], []
            for x in batch.column(1):
                ids = np.frombuffer(library.encode(x.as_py() or "") + tail, "<u4").astype(f"<u{width}").tobytes()
                frames.append(zstd.compress(ids))
                sizes.append(len(ids))
                sums.append(xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(shard, pa.int32()), pa.array(frames, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                names=["key", "shard", "frame", "size", "checksum"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = storage.place(folder)
        shard, out, done = None, None, []

        def finish() -> None:
            writer.close(width)
            size = out.tell()
            out.close()
            done.append((shard, name, size, len(writer.keys), sum(t[1] for t in writer.table) // width))

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if out is not None:
                        finish()
                    shard = row["shard"]
                    name = storage.fresh_name(f"shard-{shard:06d}", ".ids.zst")
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    writer = ShardWriter(out)
                writer.add(row["key"], row["frame"], row["size"], row["checksum"])
        if out is not None:
            finish()
        columns = list(zip(*done)) or [[]] * 5
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "name", "size", "n_docs", "n_tokens"])

    frames = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(
        encode, "key bigint, shard int, frame binary, size bigint, checksum bigint"
    )
    ordered = frames.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", F.asc_nulls_first("key"), "frame")
    written = sorted(ordered.mapInArrow(write, "shard int, name string, size bigint, n_docs bigint, n_tokens bigint").collect())
    start, table = 0, []
    for shard, name, size, n_docs, n_tokens in written:  # at most MOST_SHARDS rows
        table.append((shard, f"{folder}/{name}", size, n_docs, n_tokens, start))
        start += n_tokens
    schema = "shard int, path string, size bigint, n_docs bigint, n_tokens bigint, start bigint"
    spark.createDataFrame(table, schema).coalesce(1).write.parquet(f"{folder}/shards.parquet")
    return spark.read.schema(schema).parquet(f"{folder}/shards.parquet")


def read_ids(spark: SparkSession, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) and ids_crc32 of each
    document in the shards below ``folder``, or only of the ``wanted`` ids, whose frames alone
    are then decompressed. A frame that does not fit its checksum fails the job."""
    shards = spark.read.parquet(f"{folder}/shards.parquet")
    asked = None if wanted is None else set(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = storage.place(row["path"])
                with system.open_input_file(path) as file:
                    shard = ShardReader(file, row["size"])
                    lengths = shard.table[:, 1].astype(np.int64) // shard.width
                    starts = row["start"] + np.concatenate([[0], np.cumsum(lengths)])
                    out: list[tuple] = []
                    for k, key in enumerate(shard.keys):
                        if asked is None or key in asked:
                            ids = shard.ids(k).astype("<u4").tobytes()
                            out.append((key, int(starts[k]), len(ids) // 4, ids, zlib.crc32(ids)))
                        if len(out) == 1000 or k == len(shard.keys) - 1:
                            columns = list(zip(*out)) or [[]] * 5
                            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
                            out = []

    schema = T.StructType.fromDDL("doc_id bigint, start bigint, n_tokens bigint, ids binary, ids_crc32 bigint")
    names = schema.names
    count = max(1, shards.count())
    return shards.repartition(count, "shard").mapInArrow(read, schema)
