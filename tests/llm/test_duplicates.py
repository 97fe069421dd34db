"""Near duplicates, benchmark passages and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dugout.llm import bagminhash, decontaminate, imatch
from dugout.llm.common import ship_package

RNG = random.Random(4)
WORDS = ["".join(RNG.choice("abcdefghij") for _ in range(4)) for _ in range(600)]


def prose(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return words


def test_signatures_estimate_weighted_jaccard_without_bias():
    rng = np.random.default_rng(0)
    off = []
    for _ in range(200):
        keys = rng.integers(1, 2**62, 40).astype(np.uint64)
        keys.sort()
        left, right = rng.integers(1, 12, 40), rng.integers(1, 12, 40)
        a, b = (keys[:32], left[:32]), (keys[6:], right[6:])
        signs = bagminhash.signatures([a, b])
        off.append((signs[0] == signs[1]).mean() - bagminhash.similarity(a, b))
    assert abs(np.mean(off)) < 4 * np.std(off) / np.sqrt(len(off)) + 1e-3
    assert np.std(off) < 0.06


def test_similarity_counts_repeats():
    a, b = bagminhash.shingles("a b c d e a b c d e"), bagminhash.shingles("a b c d e")
    assert bagminhash.similarity(a, b) == pytest.approx(1 / 6)
    assert bagminhash.similarity(a, a) == 1 and bagminhash.similarity(bagminhash.shingles(""), a) == 0


def brute_classes(rows):
    """Classes by all pairs: (id, text) to the smallest id of what links connect."""
    bags = [bagminhash.shingles(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or bagminhash.similarity(bags[i], bags[j]) >= 0.8:
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return Counter((key, least[find(i)]) for i, (key, _) in enumerate(rows))


def test_classes_are_those_of_all_pairs(spark):
    ship_package(spark)
    rng = random.Random(9)
    rows, key = [], 100
    for group in range(12):
        base = prose(rng, rng.randrange(6, 160))
        for _ in range(rng.randrange(1, 9)):
            rows.append((key := key - rng.randrange(1, 3), " ".join(edited(rng, base, rng.randrange(0, 1 + len(base) // 25)))))
    hot = prose(rng, 120)  # one group holds a third of the rows, most of them copies with edits of their own
    rows += [(1000 + i, " ".join(edited(rng, hot, i % 6))) for i in range(40)]
    rows += [(2000, ""), (2001, None), (2002, "one two"), (2003, "One, two!"), (2003, "One, two!"), (2004, "x " * 4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit(1)).withColumn("class_id", F.lit("x"))
    got = Counter((r.doc_id, r.class_id) for r in bagminhash.near_duplicates(df.repartition(4)).collect())
    assert got == brute_classes(rows)


def test_bounds_lose_no_link(spark):
    """Whatever is similar enough stays below the bounds that pairs are shut out by."""
    rng = random.Random(12)
    base = prose(rng, 150)
    texts = [" ".join(edited(rng, base, i % 9)) for i in range(45)]
    df = spark.createDataFrame([(bytes([i]), t) for i, t in enumerate(texts)], "node binary, text string")
    met = bagminhash.meeting(bagminhash.prefixes(df).withColumn("label", F.col("node")))
    pairs = {(r.a[0], r.b[0]) for r in met.collect()}
    bags = [bagminhash.shingles(t) for t in texts]
    similar = {(i, j) for j in range(45) for i in range(j) if bagminhash.similarity(bags[i], bags[j]) >= 0.8}
    assert similar <= pairs and len(similar) > 20
    assert len(pairs) < 500 and bagminhash.meeting(bagminhash.prefixes(df).withColumn("label", F.lit(0))).isEmpty()


def test_copies_with_edits_of_their_own_do_not_meet(spark):
    """Below the threshold a group of near copies gives no pairs, however large it is."""
    rng = random.Random(12)
    base = prose(rng, 200)
    texts = []
    for i in range(60):
        words = list(base)
        for at in range(5, 200, 25):
            words[at] = f"own{i}x{at}"
        texts.append(" ".join(words))
    df = spark.createDataFrame([(bytes([i]), t) for i, t in enumerate(texts)], "node binary, text string")
    assert bagminhash.similarity(*[bagminhash.shingles(t) for t in texts[:2]]) < 0.8
    assert bagminhash.meeting(bagminhash.prefixes(df).withColumn("label", F.col("node"))).isEmpty()


def test_rows_without_id_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "same text here"), (7, "same text here"), (None, None)], "doc_id bigint, text string")
    got = Counter((r.doc_id, r.class_id) for r in bagminhash.near_duplicates(df).collect())
    assert got == {(None, None): 2, (7, 7): 1}
    assert bagminhash.near_duplicates(df.limit(0)).collect() == []


def test_components_of_a_long_chain(spark):
    edges = [(bytes([i]), bytes([i + 1])) for i in range(60)] + [(bytes([100]), bytes([99]))]
    labels = {bytes(r.node): bytes(r.label) for r in bagminhash.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert all(labels[bytes([i])] == bytes([0]) for i in range(61)) and labels[bytes([100])] == bytes([99])


def test_components_read_the_links_of_a_group_once(spark, monkeypatch):
    """op8: what a group's members share many links with is contracted, not joined again in every round."""
    rng = random.Random(5)
    name = lambda i: bytes([i // 256, i % 256])
    edges = {(name(rng.randrange(12)), name(12 + i)) for i in range(150) for _ in range(40)} | {(name(400 + i), name(401 + i)) for i in range(20)}
    plain, written = bagminhash.stored, []

    def counted(df, label):
        rows = plain(df, label)
        written.extend([rows.count()] if label == "edges" else [])
        return rows

    monkeypatch.setattr(bagminhash, "stored", counted)
    labels = {bytes(r.node): bytes(r.label) for r in bagminhash.components(spark.createDataFrame(list(edges), "a binary, b binary")).collect()}
    assert {labels[name(i)] for i in range(12, 162)} == {min(a for a, _ in edges)} and {labels[name(i)] for i in range(400, 421)} == {name(400)}
    assert len(edges) > 1000 and sum(written) < 1.1 * len(edges)


# --- benchmark passages ----------------------------------------------------------------------

ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
ITEMS = [(1, ITEM), (2, ITEM.upper() + "!"), (3, "short item of six words here"), (4, "tiny"), (5, None), (None, "a b c d e f g h i j k l m n"), (6, "zz " * 30)]


def leaks(spark, docs, items=ITEMS):
    a = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("key", F.lit(0)).withColumn("item_id", F.lit(0))
    b = spark.createDataFrame(items, "item_id bigint, text string").withColumn("words", F.lit("clash"))
    return {(r.doc_id, r.item_id): r for r in decontaminate.overlaps(a, b).collect()}


def replaced(n, *at):
    words = ITEM.split()
    for i in at:
        words[i] = f"other{n}"
    return "before it " + " ".join(words) + " and after"


DOCS = [
    (10, replaced(0)), (11, replaced(1, 8)), (12, replaced(2, 4, 12)), (13, "nothing of the kind " * 50), (14, None), (15, ""),
    (16, "x Short item, of SIX words here y"), (17, "tiny"), (None, replaced(0)), (10, replaced(0)), (18, "zz " * 500), (19, "one two three four nine ten " * 5),
]


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_passages_are_found_despite_replaced_words(spark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", bound)  # by shuffle and by broadcast alike
    got = leaks(spark, DOCS)
    assert set(got) == {(10, 1), (11, 1), (12, 1), (16, 3), (None, 1), (18, 6)}
    assert got[10, 1].coverage == 1 and got[11, 1].matched_words == 15 and got[12, 1].matched_words == 14
    assert got[10, 1].at == 2 and got[16, 3].at == 1


def test_every_two_replaced_words_in_an_item_of_sixteen(spark):
    docs = [(i * 100 + j, replaced(0, i, j)) for i in range(16) for j in range(i)]
    found = {k for k, _ in leaks(spark, docs)}
    assert len(found) >= 0.95 * len(docs)


def test_no_benchmark_no_documents(spark):
    assert leaks(spark, DOCS, [(None, None)]) == {} and leaks(spark, [(1, None)]) == {}
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == ["doc_id", "text", "lang"]
    assert sorted(r.doc_id for r in kept.collect()) == [13, 14, 15, 17, 19]


def test_no_python_on_the_main_path(spark):
    import inspect

    source = inspect.getsource(decontaminate)
    assert "udf" not in source and "mapIn" not in source and ".rdd" not in source


# --- fingerprints ----------------------------------------------------------------------------


def test_fingerprints_in_order(spark):
    ship_package(spark)
    rng = random.Random(2)
    rows = [(i, " ".join(prose(rng, rng.randrange(1, 80)))) for i in range(60)] + [(60, None), (61, ""), (30, "twice"), (None, "no id here")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("range", F.lit("x")).withColumn("guest", F.lit("x"))
    kept = imatch.lexicon(df, low=0.0)
    got = imatch.compared_in_order(df.repartition(3), kept).collect()
    order = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    printer = imatch.Printer(kept)
    want = Counter()
    for (key, text), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        new = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        want[(key, len(text), hashlib.sha256(new.encode()).hexdigest(), *map(printer.fingerprint, (text, new, following)))] += 1
    assert Counter(tuple(r) for r in got) == want


def test_likeness_is_taken_where_the_prints_are_made(spark, tmp_path):
    """op1: the likeness beside the fingerprints is that of the column expression, which the query no longer runs."""
    from dugout.llm.queries import QUERIES

    rng = random.Random(3)
    texts = [" ".join(prose(rng, rng.randrange(1, 60))) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts + texts[:5] + ["", None, "..."])] + [(None, "no id"), (7, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op1_imatch"](spark, str(tmp_path))
    assert "substring" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    by_column = imatch.compared_in_order(df, imatch.lexicon(df))
    near = [imatch.likeness(F.col("fingerprint"), F.col(c)).alias(f"near_{c}") for c in ("edited_fingerprint", "next_fingerprint")]
    want = by_column.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *near)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("rows", [[], [(5, "alone in the table")], [(None, None)]])
def test_fingerprints_of_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = imatch.compared_in_order(df, imatch.lexicon(df)).collect()
    assert [(r.doc_id, r.fingerprint == r.next_fingerprint) for r in got] == [(k, True) for k, _ in rows]


def test_likeness_of_equal_near_and_other_texts(spark):
    rng = random.Random(6)
    texts = [" ".join(prose(rng, 120)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id bigint, text string")
    kept = imatch.lexicon(df, low=0.5)
    p = imatch.Printer(kept)
    near = [(p.fingerprint(t), p.fingerprint(" ".join(edited(rng, t.split(), 2)))) for t in texts]
    other = [(p.fingerprint(a), p.fingerprint(b)) for a, b in zip(texts, texts[1:], strict=False)]
    mean = lambda pairs: spark.createDataFrame(pairs, "a string, b string").select(F.avg(imatch.likeness(F.col("a"), F.col("b")))).first()[0]
    assert mean([(a, a) for a, _ in near]) == 1 and mean(near) > 0.5 > 0.15 > mean(other)
    assert imatch.Printer(kept).fingerprint("") == "-" * 8 * imatch.SUBSETS


def test_likeness_with_the_production_band_and_a_group_of_copies(spark):
    rng = random.Random(16)
    texts = [" ".join(prose(rng, 60)) for _ in range(60)]
    hot, alone = "the very same words of one page in many copies today", ["unheard phrases", "nothing seen before", "!!! ???", "..."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + alone + [hot] * 40 + ["", None])], "doc_id bigint, text string")
    different, n = imatch.different_texts(df)
    assert n == 66 and sorted(r[0] for r in different.collect()) == sorted({*texts, *alone, hot, ""})
    kept = imatch.lexicon(df)
    p = imatch.Printer(kept)
    prints = [p.fingerprint(t) for t in (hot, *alone, *texts)]
    dashes = "-" * 8 * imatch.SUBSETS
    assert len(set(prints)) == len(prints) and dashes not in prints and p.fingerprint("") == p.fingerprint(" ") == dashes
    got = imatch.compared_in_order(df, kept).select("doc_id", imatch.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near")).collect()
    near = {r.doc_id: r.near for r in got}
    assert all(near[i] == 1 for i in range(65, 104)) and near[64] < 0.2 and near[104] < 0.2 and max(near[i] for i in range(1, 64)) < 0.5
    few = spark.createDataFrame([(1, "a page of words"), (2, "one other text")], "doc_id bigint, text string")
    rows = imatch.compared_in_order(few, imatch.lexicon(few)).select(imatch.likeness(F.col("fingerprint"), F.col("next_fingerprint"))).collect()
    assert [r[0] for r in rows] == [0.0, 0.0]


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_excerpts_insertions_and_short_items(spark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", bound)
    item = [f"w{i}" for i in range(40)]
    even = [f"v{i}" for i in range(36)]
    short = {n: [f"s{n}x{i}" for i in range(n)] for n in (5, 7, 10)}
    benchmark = [(1, item), (2, even), *((n, words) for n, words in short.items())]
    around = [f"x{i}" for i in range(15)]
    found = {
        1: (1, item[10:29]), 2: (1, item[3:16]), 3: (2, [*even[:18], "new", *even[18:]]), 4: (2, [*even[:18], *even[19:]]),
        5: (1, item[:12] + around + item[:12] + around + item[12:24] + around + item[24:36]),
        **{100 * n + i: (n, [*words[:i], "other", *words[i + 1 :]]) for n, words in short.items() for i in range(n)},
    }
    rows = [(k, " ".join([*around, *words, *around])) for k, (_, words) in found.items()]
    rows += [(9000, " ".join(around + item[5:11] + around)), (9001, " ".join(around + short[5][:3] + around + short[7][:5] + around))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(k, " ".join(words)) for k, words in benchmark], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.matched_words for r in decontaminate.overlaps(df, bench).collect()}
    assert set(got) == {(k, n) for k, (n, _) in found.items()}
    assert got[3, 2] == 36 and got[4, 2] == 35 and got[1, 1] == 19 and got[5, 1] == 36 and got[503, 5] == 4
