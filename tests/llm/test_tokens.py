"""Byte-level BPE and Huffman files against the libraries and exact round trips."""

from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dugout.llm import bpe, huffman
from dugout.llm.common import ship_package

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LETTERS = " \n\t'\x1c\x85\xa0　abéßñÉÄs1٣ΣσİıŸ!,.😀̀日本<|>ª've"


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


TEXTS = ["", "the end", "the  end\n\n x ", "Nein, nein.\nUnd", "a" * 3000, "The the, THE. ththreing " * 2000, "<|endoftext|>", "hello <|endoftext|> world", "a<|startoftext|>b, <|ENDOFTEXT|> X<|EndOfText|>", *odd_texts(400)]


@pytest.fixture(scope="module")
def codec():
    _, tokens, hashed = bpe._vocabulary(RANKS)
    return bpe.Codec(tokens, public_tokenizers.PATTERN, hashed)


def test_perfect_hash_is_minimal_and_finds_every_key(codec):
    assert sorted(codec.hashed.slot) == list(range(len(codec.tokens)))
    assert all(codec.hashed.index(t) == i for i, t in enumerate(codec.tokens))


def test_ids_are_those_of_the_library(codec):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in TEXTS:
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_full_cache_changes_nothing(codec, monkeypatch):
    want = [codec.encode(t) for t in TEXTS]
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    small = bpe.Codec(codec.tokens, public_tokenizers.PATTERN, codec.hashed)
    assert [small.encode(t) for t in TEXTS] == want


ROWS = [(1, "the end", "x"), (1, "the end", "x"), (None, "é", None), (2, None, "y"), (3, "", "z")]


def test_frames_keep_rows_and_ignore_clashing_columns(spark):
    ship_package(spark)
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, ids string").withColumn("key", F.lit(1)).withColumn("body", F.lit(2))
    coded = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS)
    got = sorted(((r.doc_id or 0, bytes(r.decoded)) for r in coded.collect()), key=str)
    assert got == sorted([(1, b"the end"), (1, b"the end"), (0, "é".encode()), (2, b""), (3, b"")], key=str)
    assert bpe.digests(bpe.decode(bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN), RANKS)).collect() == []


@pytest.mark.parametrize("limit", [6, 20])
def test_code_lengths_fit_and_are_the_best(limit):
    rng = np.random.default_rng(1)
    counts = (1.4 ** rng.integers(0, 30, 60)).astype(np.int64)
    counts[5] = 0
    lengths = huffman.code_lengths(counts, limit)
    used = counts > 0
    assert lengths[~used].sum() == 0 and lengths.max() <= limit
    assert sum(2.0 ** -int(n) for n in lengths[used]) == pytest.approx(1)
    if limit == 20:  # no shorter than the plain Huffman tree
        import heapq

        heap, cost = sorted(int(c) for c in counts[used]), 0
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        assert int((lengths * counts).sum()) == cost


@pytest.mark.parametrize("size", [0, 1, 127, 128, 129, 5000])
def test_pack_and_unpack(size):
    rng = np.random.default_rng(size)
    ids = np.minimum(rng.geometric(0.05, size), 400).astype(np.int64)
    counts = np.bincount(ids, minlength=3)
    coder = huffman.Coder(huffman.code_lengths(counts, 12)) if size else huffman.Coder(np.array([1, 1], np.uint8))
    packed, checkpoints = coder.pack(ids)
    assert coder.unpack(packed, checkpoints, size).tolist() == ids.tolist()


def test_one_symbol_and_none():
    assert huffman.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]
    assert huffman.code_lengths(np.array([0])).tolist() == [0]


@pytest.mark.parametrize("width", [2, 4])
def test_word_ids_are_those_of_the_library(width):
    library = Tokenizer.from_file(WORDS)
    own = huffman.WordEncoder(open(WORDS, encoding="utf-8").read(), width)
    for text, want in zip(TEXTS, library.encode_batch(TEXTS, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.encode(text), f"<u{width}").tolist() == want.ids


def test_every_letter_of_the_plain_path_is_that_of_the_library():
    library = Tokenizer.from_file(WORDS)
    own = huffman.WordEncoder(open(WORDS, encoding="utf-8").read(), 2)
    texts = [f"a{chr(c)} {chr(c)}b. X{chr(c)}{chr(c)}, {chr(c)}" for c in range(0x20, 0x2FFF)] + ["The Quick, brown. fox.. jumps,. 3x a.b", "ÀÉÎ œuvre. ŁÓDŹ, İzmir ıı ŉa ſs"]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.encode(text), "<u2").tolist() == want.ids, text


@pytest.mark.parametrize("kept", [0, 60, 400_000])
def test_words_with_marks_and_words_met_before(monkeypatch, kept):
    """op10: marks behind letters don't lead to the library, and words of an earlier batch are not merged again."""
    monkeypatch.setattr(huffman, "CACHE_WORDS", kept)
    monkeypatch.setattr(huffman, "HELD_WORDS", 50)
    library = Tokenizer.from_file(WORDS)
    own = huffman.WordEncoder(open(WORDS, encoding="utf-8").read(), 2)
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    rng = random.Random(8)
    ends = ["", *marks, "!!!", "'s", "'ll.", "'t***", "...", "&&&", "|~", "<|endoftext|>", "-<|", "s'", "\u0338", "=\u0338", "\u0301!"]
    words = [w + e for w in ("Straße", "plain", "ÉTÉ", "l", "ÀÖ") for e in ends]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(60)] + [" ".join(words), ""]
    for text, ids in own.encode_rows([(t, t) for t in texts]):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    asked, merged, plain = [], [], own.merger.piece_ids
    monkeypatch.setattr(own, "_encode", lambda word: asked.append(word) or np.array(library.encode(word, add_special_tokens=False).ids, "<u2").tobytes())
    monkeypatch.setattr(own.merger, "piece_ids", lambda pieces: merged.extend(pieces.to_pylist()) or plain(pieces))
    assert [t for t, _ in own.encode_rows([(" ".join(["plain" + m for m in marks if m != "'"]),) * 2])] and not asked
    assert not merged or kept < 400_000


def test_files_give_documents_back_in_order(spark, tmp_path, monkeypatch):
    ship_package(spark)
    library = Tokenizer.from_file(WORDS)
    rows = [(i * 7 % 101, t) for i, t in enumerate(TEXTS[:90])] + [(5, "twice"), (5, "twice"), (None, "no id"), (200, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("start", F.lit("clash")).withColumn("ids", F.lit(0))
    path = huffman.store(df.repartition(3), WORDS, end_id=1, path=str(tmp_path / "files"))
    got = huffman.read(spark, path).orderBy("start").collect()
    want = []
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        want.append((-1 if key is None else key, ids))
    assert sorted((-1 if r.doc_id is None else r.doc_id, bytes(r.ids)) for r in got) == sorted(want)
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert zlib.crc32(bytes(got[0].ids)) == zlib.crc32(sorted(want)[0][1])


def test_empty_table_gives_empty_files(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    path = huffman.store(df, WORDS, end_id=1, path=str(tmp_path / "none"))
    assert huffman.read(spark, path).collect() == []
