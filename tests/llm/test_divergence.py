"""Source divergences against a brute-force version in plain whole numbers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from dugout.llm import divergence
from dugout.llm.common import ship_package

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least=10, best=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        groups[lang].add(source)
        terms = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text)]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources - {s}]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, top in (("pair", pairs, None), ("term", terms, best)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:top], 1)}
    return out


def made_rows(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "THE", "été", "日本", "x", "😀", "ßa", "Éa", "word", "a1b", "tie", "eit", "K"] + [f"w{chr(97 + i)}" for i in range(20)]
    marks = [" ", "-", ", ", "\n", " ", "\x00", "_", "[", "`", "\x7f"]

    def text():
        return "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 30)))

    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "b", "b", None, "é"]), text()) for _ in range(n)]
    return [*rows, ("en", "silent", None), ("xx", "one", "rare"), ("xx", "two", ""), ("en", "a", "the " * 50_000), *rows[:20]]


COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def as_set(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_divergences_are_those_of_brute_force(spark, seed):
    ship_package(spark)
    rows = made_rows(seed)
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "lang string, source string, text string, n int, term string").repartition(5)
    assert as_set(divergence.divergences(df)) == brute(rows)
    assert as_set(divergence.divergences(df, least=1, best=3)) == brute(rows, 1, 3)


def test_spilling_at_every_document_changes_nothing(spark, monkeypatch):
    rows = made_rows(3, 60)
    held = divergence.Stripes()
    whole = Counter()
    for row in rows:
        held.fold(*(x or "" for x in row))
        for batch in held.spill(rows=3):
            for r in batch.to_pylist():
                for e in r["entries"]:
                    whole[r["lang"], r["term"], e["source"], "docs"] += e["docs"]
                    whole[r["lang"], r["term"], e["source"], "n"] += e["n"]
        assert held.entries == 0
    for row in rows:
        held.fold(*(x or "" for x in row))
    at_once = Counter()
    for batch in held.spill():
        for r in batch.to_pylist():
            for e in r["entries"]:
                at_once[r["lang"], r["term"], e["source"], "docs"] = e["docs"]
                at_once[r["lang"], r["term"], e["source"], "n"] = e["n"]
    assert whole == at_once


def test_terms_are_the_runs_of_the_pattern():
    text = "".join(map(chr, [*range(0x250), 0x2028, 0x3000, 0x1F600])) + "A-b_C[d`E{f|G~h\x7fi"
    want = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text)]
    assert [t.decode() for t in divergence.terms_of(text)] == want


def test_shares_are_exact_beyond_what_64_bits_multiply():
    counts = np.array([[0, 5, 10**12, 9 * 10**14 - 3]], np.int64)
    totals = np.array([7, 10**9 + 7, 3 * 10**12, 9 * 10**14], np.int64)
    got = divergence.share(counts, totals, 10**6 + 3)
    assert got.tolist() == [[1 + 10**9 * (int(c) + 2) // (int(t) + 2 * (10**6 + 3)) for c, t in zip(counts[0], totals, strict=True)]]


def test_empty_table(spark):
    ship_package(spark)
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.divergences(empty).count() == 0
