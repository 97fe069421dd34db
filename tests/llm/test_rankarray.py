"""Byte-level BPE over rank arrays against the unchanged library."""

from __future__ import annotations

import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dugout.llm import rankarray
from dugout.llm.common import ship_package
from dugout.llm.queries import op13_rank_array_bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = " \n\t'\x1c\x85\xa0　abéßñÉÄs1٣ΣσİıŸ!,.😀̀日本<|>ª've"


def texts():
    rng = random.Random(8)
    odd = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    marks = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "<|startoftext|>"]
    long = ["a" * 3000, "ab" * 700 + "é" * 900, "日本語" * 500, " " * 5000, "The the, THE. ththreing\n" * 3000]
    return ["", "the end", "Nein, nein.\nUnd", *marks, *long, *odd]


@pytest.fixture(scope="module")
def own():
    return rankarray.Tokenizer(open(FILE, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def ids_of(own, values):
    return [np.frombuffer(ids, "<u4").tolist() for _, ids in own.encode(enumerate(values))]


def test_ids_and_texts_are_those_of_the_library(own, library):
    want = [e.ids for e in library.encode_batch(texts(), add_special_tokens=False)]
    got = ids_of(own, texts())
    assert got == want
    flat, ends = np.array([i for g in got for i in g], np.int64), np.cumsum([len(g) for g in got])
    assert own.decode(flat, ends) == library.decode_batch(want, skip_special_tokens=False)


def test_every_character_is_cut_as_in_the_library(own, library):
    values = [f"a{chr(c)}1 {chr(c)}b  {chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    assert ids_of(own, values) == [e.ids for e in library.encode_batch(values, add_special_tokens=False)]


def test_bounds_of_batches_and_matrices_change_nothing(own, monkeypatch):
    want = ids_of(own, texts())
    for name, value in (("HELD", 7), ("CELLS", 50), ("SHORT", 3)):
        monkeypatch.setattr(rankarray, name, value)
        assert ids_of(own, texts()) == want


def test_pair_table_finds_all_pairs_and_no_others():
    rng = random.Random(1)
    pairs = {(rng.randrange(300), rng.randrange(300)): i for i in range(5000)}
    table = rankarray.PairTable(pairs)
    left, right = (x.ravel() for x in np.meshgrid(np.arange(-1, 300), np.arange(-1, 300)))
    assert table.find(left, right).tolist() == [pairs.get(p, rankarray.NONE) for p in zip(left.tolist(), right.tolist())]


def test_bytes_without_text_and_unknown_ids_decode_as_in_the_library(own, library):
    for ids in ([own.merger.byte_ids[0xE9]], [own.merger.byte_ids[0xE6], own.merger.byte_ids[0x97], 262], [10**6, 262, 60000], [50256, 50255]):
        assert own.decode(np.array(ids, np.int64), np.array([len(ids)])) == [library.decode(list(map(int, ids)), skip_special_tokens=False)]


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"decoder": None}])
def test_other_kinds_of_tokenizers_are_refused(change):
    spec = json.load(open(FILE, encoding="utf-8"))
    with pytest.raises(ValueError, match="byte-level"):
        rankarray.Tokenizer(json.dumps({**spec, **change}))


def test_tables_with_nulls_repeats_and_clashing_columns(spark, library):
    ship_package(spark)
    rows = [(1, "the end", "x", 3), (1, "the end", "x", 3), (None, "é<|endoftext|>", None, 1), (2, None, "y", 0), (3, "", "z", 9), (4, "a b " * 400_000, "w", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    coded = rankarray.encode(df, FILE)
    back = rankarray.decode(coded, FILE).collect()
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in back) == sorted((r[0] or 0, r[1] or "") for r in rows)
    counts = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in coded.collect())
    assert counts == sorted((r[0] or 0, len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert rankarray.decode(rankarray.encode(df.limit(0), FILE), FILE).count() == 0


def test_query_gives_the_digests_of_the_library(spark):
    import hashlib

    folder = "/root/testdata/sf0.001"
    found = {r["doc_id"]: r for r in op13_rank_array_bpe(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    library = Tokenizer.from_file(FILE)
    assert len(found) == len(rows)
    for row in rows:
        ids = library.encode(row["text"], add_special_tokens=False).ids
        got = found[row["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
