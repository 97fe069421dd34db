"""Byte-level BPE over contiguous rank arrays, and the way back.

The tokenizer is a definition file of the tokenizers library: byte-level pieces
and a list of merges, where the rank belongs to the *pair* of parts. A piece is an
array of parts and, beside it, an array with the rank of every two neighbours.
The smallest rank is searched, the boundary inside that pair is deleted, the two
ranks beside it are looked up anew, until no neighbours can be merged.

The different pieces of a few hundred thousand are encoded at once: pieces of
about the same length are the rows of two matrices, and each step searches,
deletes and refreshes in all rows together. Pieces longer than ``SHORT`` bytes
keep a minimum per block of ranks, so that no step scans the whole piece.

Nothing is remembered from one batch to the next; memory is bounded by a batch.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dugout.llm.common import Output, by_different, in_batches, per_batch, row_chunks, whole_text

#: Fixed value: how byte-level tokenizers of the library cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of a piece up to which it is a row of a matrix, and cells of a matrix.
SHORT = 512
CELLS = 1 << 20
#: Pieces that are encoded at once.
HELD = 300_000

NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class PairTable:
    """Ranks of pairs of parts: an open table at most a quarter full, looked up for many pairs at once."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        ranks = np.array(list(pairs.values()), np.int32)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        slots = self._slots(keys)
        while len(keys):
            taken = self.keys[slots] >= 0
            first = np.zeros(len(keys), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            put = first & ~taken
            self.keys[slots[put]], self.ranks[slots[put]] = keys[put], ranks[put]
            keys, ranks, slots = keys[~put], ranks[~put], self._next(slots[~put])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, slots: np.ndarray) -> np.ndarray:
        return slots + 1 & (1 << self.bits) - 1

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; ``NONE`` where there is none or a part is missing (negative)."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slots(keys)
        held = self.keys[slots]
        found = np.where((held == keys) & (keys >= 0) & (right >= 0), self.ranks[slots], NONE)
        rest = np.flatnonzero((held >= 0) & (held != keys) & (left >= 0) & (right >= 0))
        slots = slots[rest]
        while len(rest):
            slots = self._next(slots)
            held = self.keys[slots]
            hit = held == keys[rest]
            found[rest[hit]] = self.ranks[slots[hit]]
            on = (held >= 0) & ~hit
            rest, slots = rest[on], slots[on]
        return found


def _without(matrix: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The matrix with one cell of every row deleted."""
    keep = np.ones(matrix.shape, bool)
    keep[np.arange(len(matrix)), column] = False
    return matrix[keep].reshape(len(matrix), -1)


class Merger:
    """Merges the bytes of pieces by a list of merges.

    ``byte_ids`` has the part that each byte starts as; with ``suffix`` the last byte of a piece starts
    as the part of that suffix.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str = "") -> None:
        letters = byte_letters()
        if missing := [c for c in letters if c not in vocabulary or c + suffix not in vocabulary]:
            raise ValueError(f"{len(missing)} bytes have no token")
        self.byte_ids = np.array([vocabulary[c] for c in letters], np.int32)
        self.last_ids = np.array([vocabulary[c + suffix] for c in letters], np.int32) if suffix else None
        pairs, made = {}, []
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pairs[vocabulary[left], vocabulary[right]] = rank
            made.append(vocabulary[left + right])
        self.pairs, self.made = pairs, np.array(made, np.int32)
        self.table = PairTable(pairs)

    def piece_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each piece has."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        raw = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
        sizes = np.diff(offsets)
        order = np.argsort(sizes, kind="stable")
        counts = np.zeros(len(pieces), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        at = int(np.searchsorted(sizes[order], 1))  # empty pieces have no ids
        while at < len(order):
            if sizes[order[at]] > SHORT:
                for row in order[at:]:
                    parts = self.byte_ids[raw[offsets[row] : offsets[row + 1]]]
                    if self.last_ids is not None:
                        parts[-1] = self.last_ids[raw[offsets[row + 1] - 1]]
                    ids = self._long(parts)
                    counts[row] = len(ids)
                    done.append((np.array([row]), ids))
                break
            # As many rows as the cells allow, of at most a quarter more bytes than the first has.
            width = min(SHORT, int(sizes[order[at]]) * 5 // 4 + 1)
            stop = min(int(np.searchsorted(sizes[order], width, "right")), at + max(1, CELLS // width))
            rows = order[at:stop]
            width = int(sizes[rows[-1]])
            cells = np.arange(width)
            inside = cells < sizes[rows][:, None]
            places = np.minimum(offsets[rows][:, None] + cells, len(raw) - 1)
            parts = np.where(inside, self.byte_ids[raw[places]], np.int32(-1))
            if self.last_ids is not None:
                parts[np.arange(len(rows)), sizes[rows] - 1] = self.last_ids[raw[offsets[rows + 1] - 1]]
            for which, ids in self._merge_rows(parts):
                own = rows[which]
                counts[own] = (ids >= 0).sum(1)
                done.append((own, ids[ids >= 0]))
            at = stop
        ends = np.cumsum(counts)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, "<u4")
        for own, ids in done:
            n = counts[own]
            inner = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(ends[own] - n, n) + inner] = ids
        return out, counts

    def _merge_rows(self, parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows merged side by side; gives the numbers and parts of rows that are done."""
        number = np.arange(len(parts))
        ranks = self.table.find(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(parts), -1)
        while len(parts):
            if not ranks.shape[1]:
                yield number, parts
                return
            at = ranks.argmin(1)
            low = ranks[np.arange(len(ranks)), at]
            on = low != NONE
            if not on.all():
                yield number[~on], parts[~on]
                number, parts, ranks, at, low = number[on], parts[on], ranks[on], at[on], low[on]
                if not len(parts):
                    return
            parts[np.arange(len(parts)), at] = self.made[low]
            parts, ranks = _without(parts, at + 1), _without(ranks, at)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < ranks.shape[1])
            rows, places = np.concatenate([left, right]), np.concatenate([at[left] - 1, at[right]])
            ranks[rows, places] = self.table.find(parts[rows, places], parts[rows, places + 1])

    def _long(self, parts: np.ndarray) -> np.ndarray:
        """One long piece: ranks in blocks with a minimum each; deleted boundaries are skipped by links."""
        size = len(parts)
        block = int(size**0.5) + 1
        ranks = np.full((size // block + 1) * block, NONE, np.int32)
        ranks[: size - 1] = self.table.find(parts[:-1], parts[1:])
        blocks = ranks.reshape(-1, block)
        least = blocks.min(1)
        ids = parts.tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        get, made = self.pairs.get, self.made
        while True:
            b = int(least.argmin())
            if least[b] == NONE:
                break
            i = b * block + int(blocks[b].argmin())
            gone = after[i]
            ids[i] = int(made[ranks[i]])
            ranks[gone] = NONE
            after[i] = stop = after[gone]
            ranks[i] = get((ids[i], ids[stop]), NONE) if stop < size else NONE
            touched = {b, gone // block}
            if stop < size:
                before[stop] = i
            if (j := before[i]) >= 0:
                ranks[j] = get((ids[j], ids[i]), NONE)
                touched.add(j // block)
            for t in touched:
                least[t] = blocks[t].min()
        out, i = [], 0
        while i < size:
            out.append(ids[i])
            i = after[i]
        return np.array(out, np.int32)


class Tokenizer:
    """A byte-level tokenizer read from its definition (the text of the file).

    Definitions with a normalizer, a prefix space, unknown or sub-word marks, dropout or
    added tokens that look at their surroundings are refused.
    """

    def __init__(self, definition: str) -> None:
        spec = json.loads(definition)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type", "BPE") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and spec.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space")
            and cut.get("use_regex", True)
            and (spec.get("decoder") or {}).get("type") == "ByteLevel"
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError("only plain byte-level BPE without normalizer is encoded here")
        vocabulary, letters = model["vocab"], byte_letters()
        self.merger = Merger(vocabulary, model["merges"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"] if t["content"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        # White space as Unicode has it, without the separators that Python adds.
        self.pattern = regex.compile(PIECES.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        number = {c: b for b, c in enumerate(letters)}
        size = 1 + max([*vocabulary.values(), *self.added.values()])
        self.bytes: list[bytes | None] = [None] * size
        for token, i in [*vocabulary.items(), *self.added.items()]:
            known = all(c in number for c in token)
            self.bytes[i] = bytes(number[c] for c in token) if known else token.encode()

    def _cut(self, text: str) -> Iterator[bytes | list[str]]:
        """Added tokens as their packed ids, and what stands between them as lists of pieces."""
        at = 0
        marks = self.marks.finditer(text) if self.marks is not None else ()
        for mark in marks:
            yield from self._pieces(text[at : mark.start()])
            yield self.added[mark.group()].to_bytes(4, "little")
            at = mark.end()
        yield from self._pieces(text[at:] if at else text)

    def _pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= 4 * HELD:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, HELD)):
            yield part

    def encode(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        """For rows of a key and a text: the key and the ids, little-endian unsigned 32-bit integers."""
        return in_batches(rows, self._cut, lambda pieces: by_different(pieces, self.merger.piece_ids), HELD)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of ids that stand in a row, each ending where ``ends`` says; unknown ids are left out."""
        if not hasattr(self, "_bytes"):
            self._bytes = pa.array([b"" if t is None else t for t in self.bytes], pa.large_binary())
        ids = np.where(ids < len(self.bytes), ids, len(self.bytes))
        known = ids < len(self.bytes)
        if not known.all():
            ends = np.concatenate([[0], np.cumsum(known)])[ends]
            ids = ids[known]
        taken = self._bytes.take(pa.array(ids))
        offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        raw = memoryview(taken.buffers()[2]) if len(ids) and taken.buffers()[2] is not None else b""
        cuts = offsets[np.concatenate([[0], ends])]
        return [str(raw[a:b], "utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_HELD: dict[str, Tokenizer] = {}


def _tokenizer(name: str, definition: str) -> Tokenizer:
    """The worker's tokenizer, made once; another one takes its place."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Tokenizer(definition)
    return _HELD[name]


def _definition(path: str) -> tuple[str, str]:
    with open(path, encoding="utf-8") as file:
        text = file.read()
    Tokenizer(text)  # fails here and not in a task when the definition is of another kind
    return hashlib.sha256(text.encode()).hexdigest(), text


def encode(df: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text, without special tokens.

    Returns ``key``, ``n_tokens`` and ``ids`` (binary: little-endian unsigned 32-bit
    integers), a row per input row; other columns are not carried. The string of an
    added token in a text gives that token's id, as in the library. A null or empty
    text has no ids. Repeated rows and null keys stay; an empty table gives no rows.
    """
    name, definition = _definition(tokenizer_file)
    schema = pa.schema([("key", to_arrow_type(df.schema[key].dataType)), ("ids", pa.binary())])

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        return _tokenizer(name, definition).encode(rows)

    source = df.select(F.col(key).alias("key"), whole_text(text).alias("body"))
    kind = df.schema[key].dataType.simpleString()
    coded = source.mapInArrow(per_batch(run, schema), f"key {kind}, ids binary").withColumnRenamed("key", key)
    return coded.select(key, F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"), "ids")


def decode(df: DataFrame, tokenizer_file: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts that the ids stand for: ``key``, ``ids`` as given and ``decoded``.

    Null ids decode to the empty text, ids outside the vocabulary to nothing, and
    bytes that are no UTF-8 to replacement characters, as in the library.
    """
    name, definition = _definition(tokenizer_file)
    schema = pa.schema([("key", to_arrow_type(df.schema[key].dataType)), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, out = _tokenizer(name, definition), Output(schema)
        for keys, column in row_chunks(batches):
            packed = [p or b"" for p in column]
            ends = np.cumsum([len(p) // 4 for p in packed])
            texts = tokenizer.decode(np.frombuffer(b"".join(packed), "<u4"), ends)
            for k, p, t in zip(keys, packed, texts, strict=True):
                if out.add((k, p, t), len(p) + len(t)):
                    yield out.batch()
        if out.columns[0]:
            yield out.batch()

    source = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = df.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, ids binary, decoded string").withColumnRenamed("key", key)
