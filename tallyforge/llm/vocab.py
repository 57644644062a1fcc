"""What the byte-pair operators share: the split into pieces, vocabularies, a bounded cache."""

from __future__ import annotations

import base64
import json
import struct
from collections.abc import Callable

import public_tokenizers
import regex

#: Pieces that are merged separately. White space is Unicode's, as in the tokenizer libraries.
PIECES = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def read_file(path: str) -> bytes:
    """A vocabulary file on the driver; its bytes travel to the tasks."""
    with open(path, "rb") as file:
        return file.read()


def rank_file(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 stands
    for itself, the other bytes take the letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def merge_file(data: bytes) -> tuple[list[int], dict[tuple[int, int], tuple[int, int]], list[str]]:
    """(id of each byte, (left, right) to (rank, merged id), special strings) of a byte-level
    BPE in the tokenizers library's JSON."""
    parsed = json.loads(data)
    vocab = parsed["model"]["vocab"]
    letters = byte_letters()
    ids = [0] * 256
    for letter, byte in letters.items():
        ids[byte] = vocab[letter]
    merges = {}
    for rank, pair in enumerate(parsed["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
    return ids, merges, [t["content"] for t in parsed.get("added_tokens", [])]


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceCache:
    """Values of pieces, computed once while they are among the recently used. Two
    generations of up to ``limit`` entries; pieces over ``longest`` characters are not kept."""

    def __init__(self, compute: Callable[[list[str]], list], limit: int = 400_000, longest: int = 200):
        self.compute, self.limit, self.longest = compute, limit, longest
        self.young: dict = {}
        self.old: dict = {}

    def values(self, pieces: list[str]) -> list:
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        if None not in found:
            return found
        unknown = []
        for piece in {p for p, v in zip(pieces, found) if v is None}:
            value = old.get(piece)
            if value is None:
                unknown.append(piece)
            else:
                young[piece] = value
        if unknown:
            young.update(zip(unknown, self.compute(unknown)))
        found = list(map(young.__getitem__, pieces))
        for piece in unknown:
            if len(piece) > self.longest:
                del young[piece]
        if len(young) > self.limit:
            self.old, self.young = young, {}
        return found
