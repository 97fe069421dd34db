"""Spelling variants against a brute-force version over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dugout.llm import spelling
from dugout.llm.common import ship_package
from dugout.llm.queries import op11_spelling_variants


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(rows, every=31):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return counts


def brute(rows, every=31, ratio=10):
    counts = brute_counts(rows, every)
    kept = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    others = {w: [v for v in kept if near(w, v)] for w in kept}
    form = {}
    for w, n in kept.items():
        best = min(others[w], key=lambda v: (-kept[v], v), default=None)
        form[w] = best if best is not None and kept[best] >= ratio * n else None
    out = set()
    for w, n in kept.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(others[w]), kept.get(form[w])))
    return out


def as_set(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made_rows(seed, texts=60):
    """Texts of few letters, with words that differ by a letter and chains of rare spellings."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abéÀ×y") for _ in range(rng.randint(6, 10))) for _ in range(25)]
    words = stems + [s[: (i := rng.randrange(len(s)))] + rng.choice("abcÿ") + s[i + rng.randint(0, 1) :] for s in stems for _ in range(4)]
    chain = ["aaaaaaab"] * 300 + ["aaaaaabb"] * 30 + ["aaaaabbb"] * 3 + ["aaaabbbb"] * 2
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", "!"]) for _ in range(40))) for i in range(texts)]
    return [*rows, (None, " ".join(chain)), (7, None), (8, ""), (None, "Straßenbahn STRAßENBAHN ÉCOLIERS écoliers")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_are_those_of_all_pairs(spark, seed):
    ship_package(spark)
    rows = made_rows(seed)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n int")
    want = brute(rows)
    assert as_set(spelling.variants(df)) == want
    assert any(form and root != form for _, form, root, *_ in want)
    assert as_set(spelling.variants(df, every=2, ratio=3)) == brute(rows, 2, 3)


def test_repeated_rows_count_and_empty_tables_have_no_words(spark):
    ship_package(spark)
    rows = [(1, "wonderful"), (1, "wonderful"), (2, "wonderfull wonderfull"), (3, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_set(spelling.variants(df)) == brute(rows)
    assert spelling.variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="more frequent"):
        spelling.variants(df, ratio=1)


def test_a_very_long_text(spark):
    ship_package(spark)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcd") for _ in range(8)) for _ in range(300)]
    rows = [(1, " ".join(rng.choice(words) for _ in range(150_000))), (2, "a" * 300_000)]
    assert as_set(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_every_near_pair_shares_a_signature():
    rng = random.Random(6)
    for _ in range(300):
        a = "".join(rng.choice("abcdé") for _ in range(rng.randint(7, 14)))
        i = rng.randrange(len(a))
        pairs = [(a, a[:i] + "x" + a[i + 1 :], 0, spelling.EQUAL_PARTS), (a, a[:i] + rng.choice("ax") + a[i:], 1, spelling.LONGER_PARTS)]
        for one, other, more, parts in pairs:
            mine, yours = (
                {int(s[0]) for s in spelling._signatures(np.array([[ord(c) for c in w]], np.uint32), len(w) - less, parts)}
                for w, less in ((one, 0), (other, more))
            )
            assert mine & yours


def test_query_on_whole_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = as_set(op11_spelling_variants(spark, folder))
    counts = {r[0]: r[3] for r in found}
    assert len(found) > 100
    # All pairs of that many words take too long; near words are made from each word instead.
    letters = sorted({c for w in counts for c in w})
    for word, form, root, n, n_near, form_n in found:
        around = {word[:i] + c + word[i + k :] for i in range(len(word) + 1) for k in (0, 1) for c in letters} | {word[:i] + word[i + 1 :] for i in range(len(word))}
        others = (around - {word}) & counts.keys()
        assert n_near == len(others)
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        assert form == (best if best is not None and counts[best] >= 10 * n else None)
        assert form_n == counts.get(form)
        assert (root == word) == (form is None)
    words = {(w, n) for w, _, _, n, *_ in found}
    assert words == {(w, n) for w, n in brute_counts(rows).items() if len(w) >= 7 and n >= 2}
