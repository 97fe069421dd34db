"""Byte-level BPE by a two-tier lookup, and the way back.

Tier one is a minimal perfect hash over the whole vocabulary: a pre-token that is
itself in the vocabulary is resolved by one hash and one comparison. Tier two
takes the others: the bytes form a linked list, a heap holds the mergeable
neighbours by rank, and the lowest rank is merged until none is left.

The vocabulary is a rank file; its size is fixed, so its tables travel with the
tasks. Texts without runs of white space are cut at line breaks and spaces, where
a pre-token always starts; others are cut by the pattern. The ids of pre-tokens
are remembered in a cache of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import per_row, whole_text

#: Pre-tokens in each half of a worker's cache. When the younger half is full it becomes the older one,
#: from which pre-tokens that are met again come back.
CACHE_PIECES = 250_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in the order of their ids, which run from 0 without gaps."""
    with open(path, "rb") as lines:
        pairs = [(int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in lines if line.strip())]
    pairs.sort()
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must run from 0 without gaps")
    if len({token for _, token in pairs}) != len(pairs):
        raise ValueError("a token has two ranks")
    if sum(len(token) == 1 for _, token in pairs) != 256:
        raise ValueError("every single byte needs a rank")
    return [token for _, token in pairs]


class PerfectHash:
    """Minimal perfect hash by hash and displace: as many slots as keys.

    Keys are dealt to small buckets. From the fullest bucket on, each gets the
    first displacement that puts its keys on free slots; buckets of one key are
    sent straight to the slots left over.
    """

    BUCKET = 2

    def __init__(self, keys: list[bytes]) -> None:
        self.size = len(keys)
        self.buckets = max(1, len(keys) // self.BUCKET)
        members: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for i, key in enumerate(keys):
            h = xxhash.xxh3_64_intdigest(key)
            members[h % self.buckets].append((i, h))
        self.shift = [0] * self.buckets
        self.slot = [-1] * self.size
        single = []
        for bucket in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            own = members[bucket]
            if len(own) < 2:
                single += [(bucket, i) for i, _ in own]
                continue
            for shift in range(1000 * self.size):
                slots = {self._place(h, shift) for _, h in own}
                if len(slots) == len(own) and all(self.slot[s] < 0 for s in slots):
                    break
            else:
                raise ValueError("two keys hash alike")
            self.shift[bucket] = shift
            for i, h in own:
                self.slot[self._place(h, shift)] = i
        free = [s for s, i in enumerate(self.slot) if i < 0]
        for (bucket, i), slot in zip(single, free, strict=True):
            self.shift[bucket] = -1 - slot
            self.slot[slot] = i

    def _place(self, h: int, shift: int) -> int:
        x = (h + shift * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        return ((x ^ x >> 31) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF) % 0xFFFFFFFB % self.size

    def index(self, key: bytes) -> int:
        """Where the key stood in the list, if it is one of the keys; else any number."""
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[h % self.buckets]
        return self.slot[-1 - shift if shift < 0 else self._place(h, shift)]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: neighbours merged by lowest rank, the leftmost first among equals.

    A heap entry packs rank, start and end of the pair into one number.
    """
    size = len(piece)
    bits = size.bit_length()
    mask = (1 << bits) - 1
    get, push, pop = ranks.get, heapq.heappush, heapq.heappop
    end = list(range(1, size + 1))  # end of the part that starts here; 0 when it was merged away
    before = list(range(-1, size - 1))  # start of the part to the left
    heap = [
        rank << 2 * bits | i << bits | i + 2
        for i in range(size - 1)
        if (rank := get(piece[i : i + 2])) is not None
    ]
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        stop, i = entry & mask, entry >> bits & mask
        middle = end[i]
        if not middle or middle >= stop or end[middle] != stop:
            continue  # a part of this pair has been merged meanwhile
        end[i], end[middle] = stop, 0
        if stop < size:
            before[stop] = i
            last = end[stop]
            if (rank := get(piece[i:last])) is not None:
                push(heap, rank << 2 * bits | i << bits | last)
        if i:
            left = before[i]
            if (rank := get(piece[left:stop])) is not None:
                push(heap, rank << 2 * bits | left << bits | stop)
    ids, i = [], 0
    while i < size:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Codec:
    """Encodes and decodes with one vocabulary; holds the caches of a worker."""

    def __init__(self, tokens: list[bytes], pattern: str, hashed: PerfectHash) -> None:
        self.tokens = tokens
        self.packed = [i.to_bytes(4, "little") for i in range(len(tokens))]
        self.hashed = hashed
        self.ranks = {token: i for i, token in enumerate(tokens)}
        # White space as Unicode has it, without the separators that Python adds.
        space = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pieces_of = regex.compile(space).findall
        self.white_run = regex.compile(r"\p{White_Space}{2}").search
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a pre-token, as little-endian unsigned 32-bit integers."""
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                raw = piece.encode()
                whole = self.hashed.index(raw)
                numbers = [whole] if self.tokens[whole] == raw else merged(raw, self.ranks)
                ids = b"".join(map(self.packed.__getitem__, numbers))
            if len(self.pieces) >= CACHE_PIECES:
                self.pieces, self.older = {}, self.pieces
            if len(piece) <= 64:
                self.pieces[piece] = ids
        return ids

    def text_ids(self, text: str) -> bytes:
        return b"".join(map(self.piece_ids, self.pieces_of(text)))

    def line_ids(self, line: str) -> bytes:
        """Ids of a line without neighbouring white space: a pre-token starts at every space."""
        words = line.split(" ")
        head = words[0]
        words = list(map(" ".__add__, words[1:]))
        found = list(map(self.pieces.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    word = words[i]
                    stem, mark = word[1:-1], word[-1:]
                    if mark in ".," and stem.isalpha():
                        found[i] = self.piece_ids(word[:-1]) + self.piece_ids(mark)
                    elif word[1:].isalpha():
                        found[i] = self.piece_ids(word)
                    else:
                        found[i] = self.text_ids(word)
        return self.text_ids(head) + b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids of a text."""
        if self.white_run(text):
            return self.text_ids(text)
        return self.piece_ids("\n").join(map(self.line_ids, text.split("\n")))

    def decode(self, ids: bytes) -> bytes:
        return decoded_bytes(ids, self.tokens)


def decoded_bytes(ids: bytes, tokens: list[bytes]) -> bytes:
    """The bytes of ids given as little-endian unsigned 32-bit integers."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[str, Codec] = {}


def _codec(key: str, tokens: list[bytes], pattern: str, hashed: PerfectHash) -> Codec:
    """The worker's codec of a vocabulary, made once."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(tokens, pattern, hashed)
    return _CODECS[key]


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> tuple[str, list[bytes], PerfectHash]:
    tokens = read_ranks(path)
    return hashlib.sha256(b"\0".join(base64.b64encode(t) for t in tokens)).hexdigest(), tokens, PerfectHash(tokens)


def encode(df: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text.

    Returns ``key``, ``n_tokens`` and ``ids`` (binary: little-endian unsigned
    32-bit integers), a row per input row; other columns are not carried. A null
    or empty text has no ids. Repeated rows and null keys stay.
    """
    name, tokens, hashed = _vocabulary(rank_file)

    def make(k, body):
        ids = _codec(name + pattern, tokens, pattern, hashed).encode(body)
        return (k, len(ids) // 4, ids), len(ids)

    source = df.select(F.col(key).alias("key"), whole_text(text).alias("body"))
    schema = pa.schema([("key", _arrow_type(df, key)), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    kind = df.schema[key].dataType.simpleString()
    return source.mapInArrow(per_row(make, schema), f"key {kind}, n_tokens bigint, ids binary").withColumnRenamed("key", key)


def decode(df: DataFrame, rank_file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Bytes that the ids stand for: ``key``, ``ids`` as given and ``decoded``; null ids decode to nothing.

    An id outside the vocabulary fails the job.
    """
    tokens = _vocabulary(rank_file)[1]

    def make(k, packed):
        packed = packed or b""
        decoded = decoded_bytes(packed, tokens)
        return (k, packed, decoded), len(packed) + len(decoded)

    schema = pa.schema([("key", _arrow_type(df, key)), ("ids", pa.binary()), ("decoded", pa.binary())])
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return source.mapInArrow(per_row(make, schema), f"key {kind}, ids binary, decoded binary").withColumnRenamed("key", key)


def digests(coded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Digest columns of rows that hold ``ids`` and ``decoded``."""
    return coded.select(
        key,
        F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
