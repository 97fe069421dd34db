"""Revisits against a brute-force join; the pipeline against its stages done by hand."""

from __future__ import annotations

import os
import random
import sys
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import corpus_pipeline  # noqa: E402
from check_queries import connect, rows_of  # noqa: E402

from dugout.llm import bagminhash, decontaminate, quality, revisits, secrets, stages  # noqa: E402
from dugout.llm.common import table  # noqa: E402
from dugout.llm.queries import ORACLE, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@tables
def test_revisits_agree_with_sql(spark):
    got = QUERIES["op5_revisits"](spark, FOLDER)
    answer = connect(FOLDER).execute(ORACLE["op5_revisits"])
    want = rows_of([d[0] for d in answer.description], answer.fetchall())
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == want


@pytest.mark.parametrize(
    "uri, want",
    [
        ("HTTP://www.Site.org:80/A?b=2&utm_source=x&a=1#f", "site.org/A?a=1&b=2"), ("https://u:p@site.org", "site.org/"), ("https://m.site.org/?ref=1", "m.site.org/"),
        ("site.org/a", None), ("", None), (None, None),
    ],
)
def test_canonical_addresses(spark, uri, want):
    assert spark.createDataFrame([(uri,)], "u string").select(revisits.canonical(F.col("u"))).first()[0] == want


def test_revisits_by_brute_force(spark):
    rng, start = random.Random(3), datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        uri = rng.choice(["http://hot.org/a"] * 3 + ["http://b.org/", "https://www.b.org#x", None, "no address"])
        date = None if rng.random() < 0.02 else start + timedelta(seconds=rng.randrange(60))
        headers = {k: v for k, v in (("etag", rng.choice(['"1"', 'W/"1"', '"2"', None])), ("content-type", f"t{i}"), ("cache-control", f"c{i}")) if v}
        rows.append((i, rng.choice(["response", "revisit", "revisit", "request"]), uri, date, headers if rng.random() < 0.95 else None, f"d{i}"))
    rows += [rows[0], rows[1]]
    df = spark.createDataFrame(rows, "record_id bigint, type string, uri string, date timestamp, headers map<string,string>, payload_digest string").withColumn("site", F.lit("clash"))
    got = Counter((r.record_id, r.response_id, r.status, r.payload_digest, tuple(sorted((r.headers or {}).items()))) for r in revisits.resolve(df).collect())
    site = {"http://hot.org/a": "h", "http://b.org/": "b", "https://www.b.org#x": "b"}
    want = Counter()
    for key, kind, uri, date, headers, _ in rows:
        if kind != "revisit":
            continue
        earlier = [r for r in rows if r[1] == "response" and date and r[3] and r[3] < date and site.get(uri) and site.get(r[2]) == site[uri]]
        if not earlier:
            want[key, None, "no response", None, ()] += 1
            continue
        full = max(earlier, key=lambda r: (r[3], r[0]))
        mine, old = headers or {}, full[4] or {}
        tags = [h["etag"].removeprefix("W/") for h in (mine, old) if "etag" in h]
        if len(set(tags)) > 1:
            want[key, full[0], "changed", None, ()] += 1
        else:
            merged = {**old, **{k: v for k, v in mine.items() if k in revisits.UPDATED}}
            want[key, full[0], "resolved", full[5], tuple(sorted(merged.items()))] += 1
    assert got == want
    assert revisits.resolve(df.limit(0)).collect() == []


@tables
def test_pipeline_by_hand(spark):
    """Each stage's decisions taken one document at a time."""
    docs = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    frame = lambda kept: spark.createDataFrame(sorted(kept.items()), "doc_id bigint, text string")
    rules = quality.fit_on(frame(docs), table(spark, FOLDER, "labels"))
    kept = {i: t for i, t in docs.items() if rules.predict(quality.np.array([quality.statistics(t)]))[0] >= 0.3}
    bags = {i: bagminhash.shingles(t) for i, t in kept.items()}
    label = {i: i for i in kept}
    for i in sorted(kept):
        for j in sorted(kept):
            if j < i and label[i] != label[j] and (kept[i] == kept[j] or bagminhash.similarity(bags[i], bags[j]) >= 0.8):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    kept = {i: t for i, t in kept.items() if label[i] == i}
    items = duckdb.sql(f"select text from read_parquet('{FOLDER}/benchmark.parquet')").fetchall()
    words = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    passages = [" ".join(words(t)) for (t,) in items]
    kept = {i: t for i, t in kept.items() if not any(p in " ".join(words(t)) for p in passages)}
    scanner = secrets.fit_on(frame(kept))
    kept = {i: scanner.redacted(t) for i, t in kept.items()}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    from hashlib import sha256

    assert sorted((r.doc_id, r.decoded_sha256) for r in got) == sorted((i, sha256(t.encode()).hexdigest()) for i, t in kept.items())


@tables
def test_stages_return_the_columns_of_their_rows(spark):
    docs = table(spark, FOLDER, "documents").limit(60).withColumn("score", F.lit("own")).withColumn("class_id", F.lit("own"))
    odd = spark.createDataFrame([(None, None, None, None, None, "own", "own"), (5, "", "en", "s", 0, "own", "own"), (5, "", "en", "s", 0, "own", "own")], docs.schema)
    rows = docs.unionByName(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, FOLDER)
        assert rows.columns == docs.columns
        empty = stage(spark, docs.limit(0), FOLDER)
        assert empty.columns == docs.columns and empty.collect() == []
    kept = rows.collect()
    assert all(r.score == "own" for r in kept) and sum(r.doc_id == 5 for r in kept) <= 1


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "other text"), (None, "a b c d e f"), (4, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = stages.near_dedup(spark, df, FOLDER)
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 1, 3, 4]


def test_registration():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "byte_bpe"]
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11)) and set(ORACLE) <= set(QUERIES)
    assert decontaminate.SPAN > max(max(m) for m in decontaminate.MASKS)
