from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from dugout.plans.feeds import LINESCORE
from dugout.plans.flatten import PROBLEMS
from dugout.sources.payloads import LANDING
from dugout.sources.schemas import struct
from dugout.streaming import jobs


def _land(spark, path, *polls):
    rows = [("p", "u", {"gamePk": str(g)}, datetime.fromisoformat(t), json.dumps(b)) for g, t, b in polls]
    spark.createDataFrame(rows, struct(LANDING)).write.mode("append").parquet(path)


def _score(runs):
    return {"innings": [{"num": 1, "home": {"runs": runs}}]}


def test_ingest_takes_each_file_once(spark, tmp_path):
    bronze, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "cp"))
    _land(spark, bronze, (1, "2024-04-01T10:00:00", {}))
    for want in (1, 1, 2):
        if want == 2:
            _land(spark, bronze, (2, "2024-04-01T10:05:00", {}))
        jobs.append(jobs.landed_stream(spark, bronze), target, checkpoint).awaitTermination()
        assert spark.read.parquet(target).count() == want


def test_newest_poll_wins_across_runs(spark, tmp_path):
    bronze, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "scores", "cp"))
    _land(spark, bronze, (1, "2024-04-01T10:00:00", _score(0)), (2, "2024-04-01T10:00:00", _score(1)))
    jobs.current_linescores(jobs.landed_stream(spark, bronze), target, checkpoint).awaitTermination()
    _land(spark, bronze, (1, "2024-04-01T10:10:00", _score(3)), (2, "2024-04-01T09:00:00", _score(9)), (3, "2024-04-01T10:00:00", _score(5)))
    jobs.current_linescores(jobs.landed_stream(spark, bronze), target, checkpoint).awaitTermination()
    want = {(1, 3), (2, 1), (3, 5)}
    assert {(r.gamePk, r.homeRuns) for r in jobs.linescores(spark, target).collect()} == want
    jobs.compact_log(spark, target, jobs.INNING_KEY, jobs.SEEN_AT)
    assert len(list(Path(target).glob("version=*"))) == 1
    assert [(r.gamePk, r.homeRuns) for r in spark.read.parquet(target).orderBy("gamePk").collect()] == sorted(want)
    _land(spark, bronze, (2, "2024-04-01T11:00:00", _score(7)))
    jobs.current_linescores(jobs.landed_stream(spark, bronze), target, checkpoint).awaitTermination()
    assert {(r.gamePk, r.homeRuns) for r in jobs.linescores(spark, target).collect()} == {(1, 3), (2, 7), (3, 5)}


def test_a_batch_leaves_the_files_of_other_batches_alone(spark, tmp_path):
    bronze, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "scores", "cp"))
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(target).rglob("*.parquet")}
    _land(spark, bronze, *[(g, "2024-04-01T10:00:00", _score(g)) for g in range(20)])
    jobs.current_linescores(jobs.landed_stream(spark, bronze), target, checkpoint).awaitTermination()
    before = files()
    _land(spark, bronze, (1, "2024-04-01T10:10:00", _score(30)))
    jobs.current_linescores(jobs.landed_stream(spark, bronze), target, checkpoint).awaitTermination()
    after = files()
    assert before.items() <= after.items() and len(after) == len(before) + 1


def test_what_a_stream_leaves_out_is_kept_beside_it(spark, tmp_path):
    bronze, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "rejects", "cp"))
    _land(spark, bronze, (1, "2024-04-01T10:00:00", {"innings": [{"num": 1}, {"num": "first"}]}))
    jobs.append_rejects(jobs.landed_stream(spark, bronze), LINESCORE, target, checkpoint).awaitTermination()
    assert [(r.gamePk, r[PROBLEMS]) for r in spark.read.parquet(target).collect()] == [(1, ["inning is unreadable"])]


def test_repeated_polls_give_each_pitch_once(spark, tmp_path):
    bronze, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "pitches", "cp"))
    feed = lambda n: {"liveData": {"plays": {"allPlays": [{"about": {"atBatIndex": 0}, "playEvents": [{"isPitch": True, "index": i} for i in range(n)]}]}}}
    _land(spark, bronze, (1, "2024-04-01T10:00:00", feed(2)), (1, "2024-04-01T10:00:10", feed(3)))
    jobs.append(jobs.live_pitches(jobs.landed_stream(spark, bronze)), target, checkpoint).awaitTermination()
    _land(spark, bronze, (1, "2024-04-01T10:00:20", feed(4)))
    jobs.append(jobs.live_pitches(jobs.landed_stream(spark, bronze)), target, checkpoint).awaitTermination()
    assert sorted(r.pitchIndex for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3]


def test_refresh_touches_only_the_seasons_of_a_batch(spark, tmp_path):
    landed, root, checkpoint = (str(tmp_path / n) for n in ("landed", "seasons", "cp"))
    spark.createDataFrame([("2023-05-01", 1), ("2023-06-01", 2)], "game_date string, batter bigint").write.parquet(landed)
    whole = lambda: spark.read.parquet(landed)
    stream = jobs.landed_stream(spark, landed, {"game_date": "string", "batter": "bigint"})
    jobs.refresh_seasons(stream, root, checkpoint, [2023, 2024], whole).awaitTermination()
    found = spark.read.parquet(root)
    assert found.select("year").distinct().count() == 1 and found.agg(F.sum("batter")).first()[0] == 3


def test_seen_keys_are_kept_on_disk(spark, tmp_path):
    bronze, target, checkpoint = (str(tmp_path / n) for n in ("bronze", "pitches", "cp"))
    _land(spark, bronze, (1, "2024-04-01T10:00:00", {"liveData": {"plays": {"allPlays": [{"playEvents": [{"isPitch": True, "index": 1}]}]}}}))
    started = jobs.append(jobs.live_pitches(jobs.landed_stream(spark, bronze)), target, checkpoint)
    started.awaitTermination()
    assert any(name.startswith("rocksdb") for name in started.recentProgress[0].stateOperators[0].customMetrics)
    assert all(spark.conf.get(key, None) is None for key in jobs.STATE)
