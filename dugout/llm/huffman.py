"""Token-id files: canonical length-limited Huffman coding in independent blocks.

``token_ids`` encodes texts with a tokenizer of the tokenizers library.
``write`` counts all ids, makes one code for the whole data set and writes a
folder with three Parquet tables:

* ``codes``   id and code length; the canonical code follows from the lengths,
* ``blocks``  shard, block, ids before it in the shard, keys and id counts of the
  block's documents, the bit string, and a checkpoint (bit offset) for every
  ``CHECKPOINT`` ids,
* ``tokens``  the ids before coding, which the coding pass reads.

``read`` gives the documents back. A block holds whole documents and needs only
the code table; from the checkpoints on, all its stretches are decoded side by
side through one lookup table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dugout.llm import rankarray
from dugout.llm.common import Output, by_different, in_batches, per_batch, row_chunks, shared_path, whole_text

#: Longest code in bits, ids per block (a longer document is a block of its own), ids per checkpoint.
MAX_BITS = 20
BLOCK = 1 << 16
CHECKPOINT = 128

#: Different words and their bytes that a worker remembers with their ids; it starts anew when there are more.
CACHE_WORDS = 400_000
CACHE_BYTES = 8 << 20
#: Words that are encoded together.
HELD_WORDS = 300_000


# --- ids -------------------------------------------------------------------------------------


#: Characters at which Python splits words, and the tokenizer doesn't.
_SEPARATORS = re.compile("[\x1c-\x1f]").search


#: Words of letters that need no normalization but lower case, and the marks behind them, if any: a piece of their own.
_PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-įı-ſ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
#: How the pattern of such a tokenizer must end for that.
_PIECES = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordEncoder:
    """Encodes with a tokenizer that drops white space, each different word once.

    Such a tokenizer treats the words between spaces one by one, so a text is the words'
    ids in a row. Words of plain letters are merged together, all different ones of a
    batch at once; any other goes through the library. Strings of added tokens in a text
    are these tokens, as the library has it.
    """

    def __init__(self, definition: str, width: int = 4) -> None:
        from tokenizers import Tokenizer

        self.kind = f"<u{width}"
        self.tokenizer = Tokenizer.from_str(definition)
        self._forget()
        spec = json.loads(definition)
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        model = spec["model"]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        pattern = (steps[0].get("pattern") or {}).get("Regex", "")
        cut = steps[0].get("type") == "Split" and pattern.endswith(_PIECES)
        self.by_word = cut and kinds == ["NFC", "Replace", "Lowercase"] and model["type"] == "BPE" and not model.get("ignore_merges")
        if self.by_word:
            self.merger = rankarray.Merger(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")

    def _encode(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.kind).tobytes()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids, self.counts, self.starts = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def different_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words in a row, and how many each has; words met before are looked up all at once."""
        places = pc.index_in(words, value_set=self.words)
        unknown = words.filter(pc.is_null(places))
        found, counts = self._fresh_ids(unknown)
        own = np.where(places.is_null().to_numpy(zero_copy_only=False), 0, places.fill_null(0).to_numpy())
        own[places.is_null().to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(unknown))
        starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        all_ids, all_counts = np.concatenate([self.ids, found]), np.concatenate([self.counts, counts])
        known = pa.concat_arrays([self.words, unknown])
        if len(known) <= CACHE_WORDS and known.nbytes <= CACHE_BYTES:
            self.words, self.ids, self.counts, self.starts = known, all_ids, all_counts, starts
        else:
            self._forget()
        n = all_counts[own]
        return all_ids[np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n

    def _fresh_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words in a row, and how many each has."""
        split = pc.extract_regex(words, _PLAIN)
        plain = split.is_valid()
        split = split.filter(plain)
        merged, sizes = self.merger.piece_ids(pc.utf8_lower(split.field("letters")))
        marks = split.field("marks").dictionary_encode()
        mark_ids, mark_sizes = self.merger.piece_ids(marks.dictionary)
        which = marks.indices.to_numpy()
        behind = mark_sizes[which]
        first = np.repeat((np.cumsum(mark_sizes) - mark_sizes)[which], behind)
        others = list(map(self._encode, words.filter(pc.invert(plain)).to_pylist()))
        is_plain = plain.to_numpy(zero_copy_only=False)
        counts = np.zeros(len(words), np.int64)
        counts[is_plain] = sizes + behind
        counts[~is_plain] = np.fromiter(map(len, others), np.int64, len(others)) // np.dtype(self.kind).itemsize
        starts = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), self.kind)

        def put(at: np.ndarray, n: np.ndarray, ids: np.ndarray | None = None) -> None:
            own = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(at, n) + own] = mark_ids[first + own] if ids is None else ids

        put(starts[is_plain], sizes, merged)
        put(starts[is_plain] + sizes, behind)
        put(starts[~is_plain], counts[~is_plain], np.frombuffer(b"".join(others), self.kind))
        return out, counts

    def cut(self, text: str) -> Iterator[bytes | list[str]]:
        """The words of a text, or the ids of a text that must be encoded as a whole."""
        if not self.by_word or _SEPARATORS(text):
            yield self._encode(text)
            return
        words = text.split()
        for start in range(0, len(words), HELD_WORDS):
            yield words[start : start + HELD_WORDS]

    def encode_rows(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        """For rows of a key and a text: the key and the text's ids."""
        return in_batches(rows, self.cut, lambda words: by_different(words, self.different_ids), HELD_WORDS)

    def encode(self, text: str) -> bytes:
        return next(self.encode_rows([(None, text)]))[1]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(name: str, definition: str, width: int) -> WordEncoder:
    """The worker's encoder of a tokenizer, made once."""
    if (own := f"{name}{width}") not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[own] = WordEncoder(definition, width)
    return _ENCODERS[own]


def token_ids(
    df: DataFrame, tokenizer_file: str, end_id: int | None = None, key: str = "doc_id", text: str = "text", width: int = 4
) -> DataFrame:
    """``key`` and ``ids`` (binary, little-endian unsigned of ``width`` bytes) of every whole text.

    No special tokens are added; ``end_id`` is appended to each document if given.
    Null and empty texts have no ids but that one. Rows with a null or repeated
    key stay; other columns are not carried.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = file.read()
    name = hashlib.sha256(definition.encode()).hexdigest()
    end = b"" if end_id is None else int(end_id).to_bytes(width, "little")

    def encode(rows: Iterable[tuple]) -> Iterator[tuple]:
        return ((k, ids + end) for k, ids in _encoder(name, definition, width).encode_rows(rows))

    schema = pa.schema([("key", to_arrow_type(df.schema[key].dataType)), ("ids", pa.binary())])
    source = df.select(F.col(key).alias("key"), whole_text(text).alias("body"))
    kind = df.schema[key].dataType.simpleString()
    return source.mapInArrow(per_batch(encode, schema), f"key {kind}, ids binary").withColumnRenamed("key", key)


# --- the code --------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits for each symbol with a count, by package-merge; 0 for symbols without."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("too many symbols for that length")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels = []  # for each level, which of its items by rising weight are leaves
    packages = np.zeros(0)
    for _ in range(limit):
        items = np.concatenate([leaves, packages])
        rank = np.argsort(items, kind="stable")
        levels.append(np.cumsum(rank < len(leaves)))
        items = items[rank]
        even = len(items) // 2 * 2
        packages = items[0:even:2] + items[1:even:2]
    take = 2 * len(leaves) - 2
    bits = np.zeros(len(leaves), np.int64)
    for leaf_count in reversed(levels):
        if not take:
            break
        mine = int(leaf_count[take - 1])
        bits[:mine] += 1
        take = 2 * (take - mine)
    lengths[order] = bits
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes: by length, then by symbol, each one more than the last."""
    codes = np.zeros(len(lengths), np.uint64)
    code = last = 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        size = int(lengths[symbol])
        if size:
            code <<= size - last
            last = size
            codes[symbol] = code
            code += 1
    return codes


class Coder:
    """Packs and unpacks blocks with one code."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical(lengths)
        self.bits = max(1, int(lengths.max(initial=0)))
        if self.bits > 24:
            raise ValueError("codes of more than 24 bits don't fit the packing")

    @property
    def lookup(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length for every value of the next ``bits`` bits."""
        if not hasattr(self, "_lookup"):
            order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
            order = order[self.lengths[order] > 0]
            spans = 1 << (self.bits - self.lengths[order])
            symbols = np.repeat(order, spans)
            symbols = np.concatenate([symbols, np.zeros((1 << self.bits) - len(symbols), symbols.dtype)])
            self._lookup = symbols.astype(np.uint32), self.lengths[symbols].astype(np.uint8)
        return self._lookup

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bit string of the ids and the bit offset of each checkpoint."""
        sizes = self.lengths[ids]
        if len(ids) and not sizes.all():
            raise ValueError("an id has no code")
        ends = np.cumsum(sizes)
        offsets = ends - sizes
        total = int(ends[-1]) if len(ends) else 0
        window = self.codes[ids] << (32 - sizes - (offsets & 7)).astype(np.uint64)
        first = offsets >> 3
        out = np.zeros((total + 7) // 8 + 4, np.uint8)
        for k in range(4):
            # Bits of different ids never overlap, so their sum in a byte is their union.
            part = (window >> np.uint64(24 - 8 * k)) & np.uint64(255)
            sums = np.bincount(first + k, weights=part.astype(np.float64), minlength=len(out))
            out += sums.astype(np.uint8)
        return out[: (total + 7) // 8].tobytes(), offsets[::CHECKPOINT]

    def unpack(self, packed: bytes, checkpoints: np.ndarray, count: int) -> np.ndarray:
        """The ids; the stretches after each checkpoint advance together."""
        symbols, sizes = self.lookup
        raw = np.concatenate([np.frombuffer(packed, np.uint8), np.zeros(8, np.uint8)]).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at = np.array(checkpoints, np.int64)
        out = np.zeros((len(at), CHECKPOINT), np.uint32)
        last = count - (len(at) - 1) * CHECKPOINT  # ids of the last stretch
        mask, room = np.uint32((1 << self.bits) - 1), 32 - self.bits
        for k in range(min(CHECKPOINT, count)):
            if k == last:
                at = at[:-1]
            key = (window[at >> 3] >> (room - (at & 7)).astype(np.uint32)) & mask
            out[: len(at), k] = symbols[key]
            at = at + sizes[key]
        return out.reshape(-1)[:count]


# --- files -----------------------------------------------------------------------------------


def _count_ids(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of a partition: one row per id that it holds."""
        counts = np.zeros(0, np.int64)
        for (column,) in row_chunks(batches):
            ids = np.frombuffer(b"".join(packed or b"" for packed in column), f"<u{width}")
            own = np.bincount(ids, minlength=len(counts))
            own[: len(counts)] += counts
            counts = own
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["id", "n"])

    return run


def _blocks_of(coder: Coder, key_type: pa.DataType, width: int):
    schema = pa.schema(
        [
            ("shard", pa.int32()),
            ("block", pa.int32()),
            ("inside", pa.int64()),
            ("keys", pa.list_(key_type)),
            ("sizes", pa.list_(pa.int64())),
            ("n_ids", pa.int64()),
            ("bits", pa.binary()),
            ("checkpoints", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, inside = TaskContext.get().partitionId(), 0, 0
        keys, parts, held = [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, inside, keys, parts, held
            ids = np.concatenate(parts).astype(np.int64)
            packed, checkpoints = coder.pack(ids)
            row = [shard, number, inside, keys, [len(p) for p in parts], len(ids), packed, checkpoints.tolist()]
            number, inside, keys, parts, held = number + 1, inside + len(ids), [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for key, packed in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(packed.as_py() or b"", f"<u{width}")
                if keys and held + len(ids) > BLOCK:
                    yield block()
                keys.append(key.as_py())
                parts.append(ids)
                held += len(ids)
        if keys:
            yield block()

    return run


def write(ids: DataFrame, path: str, key: str = "doc_id", limit: int = MAX_BITS, width: int = 4) -> None:
    """Write documents' ids to ``path`` in ascending order of the key (nulls first, ties by ids).

    ``ids`` has ``key`` and ``ids`` as ``token_ids`` gives them for ``width``; null ids count as none.
    """
    spark = ids.sparkSession
    ids.select(F.col(key).alias("key"), F.col("ids")).write.option("compression", "zstd").parquet(f"{path}/tokens")
    tokens = spark.read.parquet(f"{path}/tokens")
    kind = tokens.schema["key"].dataType
    counted = tokens.select("ids").mapInArrow(_count_ids(width), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    # One row per id of the vocabulary: its size is the tokenizer's, whatever the data's.
    rows = counted.toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.int64)
    counts[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    lengths = code_lengths(counts, limit)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id bigint, bits int").coalesce(1).write.parquet(f"{path}/codes")
    ordered = tokens.repartitionByRange("key").sortWithinPartitions("key", "ids")
    fields = f"shard int, block int, inside bigint, keys array<{kind.simpleString()}>, sizes array<bigint>, n_ids bigint, bits binary, checkpoints array<bigint>"
    ordered.mapInArrow(_blocks_of(Coder(lengths), to_arrow_type(kind), width), fields).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Documents of a folder: ``key``, ``start`` (ids of all documents before), ``n_tokens``, ``ids`` (binary)."""
    codes = spark.read.parquet(f"{path}/codes").toPandas()  # as many rows as the vocabulary at most
    lengths = np.zeros(int(codes["id"].max()) + 1 if len(codes) else 1, np.uint8)
    lengths[codes["id"].to_numpy(np.int64)] = codes["bits"].to_numpy(np.uint8)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["keys"].dataType.elementType
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per written shard: its ids, and those of all shards before.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = pa.schema([("key", to_arrow_type(kind)), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    joined = blocks.join(bases, "shard").select("keys", "sizes", "n_ids", "bits", "checkpoints", (F.col("base") + F.col("inside")).alias("start"))
    name = hashlib.sha256(lengths.tobytes()).hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(name, lengths.tobytes())
        out = Output(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                keys, sizes, count, packed, checkpoints, start = (c[i].as_py() for c in batch.columns)
                ids = coder.unpack(packed, np.array(checkpoints, np.int64), count).astype("<u4")
                at = 0
                for k, n in zip(keys, sizes, strict=True):
                    if out.add((k, start + at, n, ids[at : at + n].tobytes()), 4 * n):
                        yield out.batch()
                    at += n
        if out.columns[0]:
            yield out.batch()

    found = joined.mapInArrow(run, f"key {kind.simpleString()}, start bigint, n_tokens bigint, ids binary")
    return found.withColumnRenamed("key", key)


@lru_cache(maxsize=2)
def _coder(name: str, lengths: bytes) -> Coder:
    return Coder(np.frombuffer(lengths, np.uint8))


def store(df: DataFrame, tokenizer_file: str, end_id: int | None = None, path: str | None = None) -> str:
    """Encode a table of documents and write its files below ``path`` (default: the shared folder)."""
    from tokenizers import Tokenizer

    path = path or shared_path(df.sparkSession, "token-ids")
    width = 2 if Tokenizer.from_file(tokenizer_file).get_vocab_size() <= 1 << 16 else 4
    write(token_ids(df, tokenizer_file, end_id, width=width), path, width=width)
    return path
