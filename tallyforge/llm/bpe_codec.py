"""Byte-level BPE: texts to token ids and back.

The merges of a piece are found with a segment tree over its byte positions. A leaf holds the
rank of the pair that starts there, a node the leftmost smallest rank below it, so the root is
the next merge. A merge changes three leaves - the pair itself, its right part, which is gone,
and the pair to its left - and the nodes above them: O(log n) each, O(n log n) a piece, however
long the piece. In pieces of up to SHORT bytes the next merge is found by looking at all pairs
left, which is several times faster there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pyspark.sql.types as T
from pyspark.sql import DataFrame

from .textops import free_name
from .vocab import PIECES, PieceCache, packed, rank_file, read_file

_NONE = 1 << 62
_POSITION = 32
#: Pieces kept per generation of the cache, and rows encoded or decoded at a time: with two cores
#: an executor holds four workers (encoders and decoders) beside its heap.
CACHED = 150_000
ROWS = 500
#: Bytes of a piece whose merges are found without a tree.
SHORT = 64


class ByteBpe:
    """Encoder and decoder over one table of ranks. A rank is also the id of its token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.cache = PieceCache(lambda pieces: [self._ids(p.encode()) for p in pieces], limit=CACHED)

    def _ids(self, piece: bytes) -> bytes:
        whole = self.ranks.get(piece)
        return packed(self.merge(piece) if whole is None else [whole])

    def merge(self, piece: bytes) -> list[int]:
        """Ids of the tokens left when no neighbours can be merged."""
        return self._short(piece) if len(piece) <= SHORT else self._long(piece)

    def _short(self, piece: bytes) -> list[int]:
        ranks, rank = self.ranks, self.ranks.get
        token = [piece[k : k + 1] for k in range(len(piece))]
        pairs = [rank(piece[k : k + 2], _NONE) for k in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) != _NONE:
            at = pairs.index(least)
            del pairs[at]
            token[at] += token.pop(at + 1)
            if at < len(pairs):
                pairs[at] = rank(token[at] + token[at + 1], _NONE)
            if at:
                pairs[at - 1] = rank(token[at - 1] + token[at], _NONE)
        return [ranks[t] for t in token]

    def _long(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        token = [piece[k : k + 1] for k in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        size = 1 << max(0, n - 1).bit_length()
        tree = [_NONE] * (2 * size)
        # A leaf is rank * 2^32 + position: the smallest is the leftmost of the lowest rank.
        for k in range(n - 1):
            rank = ranks.get(token[k] + token[k + 1])
            if rank is not None:
                tree[size + k] = rank << _POSITION | k
        for k in range(size - 1, 0, -1):
            left, right = tree[2 * k], tree[2 * k + 1]
            tree[k] = left if left < right else right
        while (least := tree[1]) != _NONE:
            at = least & (1 << _POSITION) - 1
            gone = after[at]
            follow = after[gone]
            token[at] += token[gone]
            token[gone] = None
            after[at] = follow
            changed = [(gone, _NONE)]
            if follow < n:
                before[follow] = at
                rank = ranks.get(token[at] + token[follow])
                changed.append((at, _NONE if rank is None else rank << _POSITION | at))
            else:
                changed.append((at, _NONE))
            ahead = before[at]
            if ahead >= 0:
                rank = ranks.get(token[ahead] + token[at])
                changed.append((ahead, _NONE if rank is None else rank << _POSITION | ahead))
            for k, value in changed:
                k += size
                if tree[k] == value:
                    continue
                tree[k] = value
                while k > 1:
                    other = tree[k ^ 1]
                    k >>= 1
                    least = value if value < other else other
                    if tree[k] == least:
                        break
                    tree[k] = value = least
        return [ranks[t] for t in token if t is not None]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(self.cache.values(PIECES.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(data: bytes) -> ByteBpe:
    """Kept as long as the worker process, with its cache of pieces."""
    return ByteBpe(rank_file(data))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def _encoder(shared, keep: list[str], names: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in _parts(batches):
            ids = [codec.encode(x.as_py() or "") for x in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(ids, pa.binary())], names=names)

    return run


def _decoder(shared, keep: list[str], names: list[str], ids: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in _parts(batches):
            found = [codec.decode(x.as_py() or b"") for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(found, pa.binary())], names=names)

    return run


def _mapped(df: DataFrame, maker, path: str, source: str, keep: list[str] | None, into: str) -> DataFrame:
    keep = df.columns if keep is None else keep
    if into in keep:
        raise ValueError(f"column {into} is there already: choose another name")
    shared = df.sparkSession.sparkContext.broadcast(read_file(path))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(into, T.BinaryType())])
    own = free_name("tf_source", keep)
    return df.select(*keep, F.col(source).alias(own)).mapInArrow(maker(shared, keep, schema.names, own), schema)


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, into: str = "ids") -> DataFrame:
    """The columns ``keep`` (default all) and the ids of every whole text, as little-endian
    unsigned 32-bit integers in one binary.

    A null or empty text has no ids. Texts of any length are encoded whole; a piece without
    white space of a million bytes takes seconds, not hours. Repeated rows and ties need
    nothing: each row stands for itself. ``path`` is a rank file on the driver (a few
    megabytes; it is broadcast). A kept column called ``into`` is an error.
    """
    return _mapped(docs, _encoder, path, text, keep, into)


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None, into: str = "decoded") -> DataFrame:
    """The columns ``keep`` and the bytes that the ids stand for; null ids give no bytes.
    An id outside the vocabulary fails the job."""
    return _mapped(encoded, _decoder, path, ids, keep, into)


def digests(encoded: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``encoded``, n_tokens, ids_sha256 and the decoded_sha256 of a
    round trip."""
    keep = [c for c in encoded.columns if c != ids] if keep is None else keep
    decoded = free_name("tf_decoded", [*keep, ids])
    both = decode(encoded, path, ids, [*keep, ids], decoded)
    return both.select(
        *keep,
        (F.octet_length(ids) / 4).cast("bigint").alias("n_tokens"),
        F.sha2(F.col(ids), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )


