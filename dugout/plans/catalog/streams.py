"""Streaming jobs that run over everything that has landed, then stop."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugout.plans.catalog.base import obj, payloads, query, table
from dugout.plans.catalog.feeds import live_payload
from dugout.plans.catalog.pitches import ANY_YEAR, ORDER_TYPES
from dugout.plans.feeds import LINESCORE
from dugout.session import scratch_path
from dugout.sources import pitches
from dugout.streaming import jobs

EVENT_TYPES = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
    "value": "double", "props": "string",
}


def _paths(spark, name):
    return scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")


def _events(spark, folder):
    return jobs.landed_stream(spark, folder, EVENT_TYPES, "events.parquet")


@query("select * from events")
def stream_ingest(spark, folder):
    target, checkpoint = _paths(spark, "ingest")
    jobs.append(_events(spark, folder), target, checkpoint).awaitTermination()
    return spark.read.parquet(target)


@query("select distinct user_id, event_type from events")
def stream_dedup(spark, folder):
    target, checkpoint = _paths(spark, "dedup")
    once = jobs.once_each(_events(spark, folder), ("user_id", "event_type"), "ts", "60 days")
    jobs.append(once.select("user_id", "event_type"), target, checkpoint).awaitTermination()
    return spark.read.parquet(target)


@query("""
select distinct l_orderkey as "gamePk", l_linenumber::bigint as "atBatIndex", l_suppkey as "pitchIndex" from lineitem""")
def stream_live_pitches(spark, folder):
    """Every payload is polled twice, a minute apart; each pitch arrives once."""
    bronze = scratch_path(spark, "live-bronze")
    target, checkpoint = _paths(spark, "live")
    landed = payloads(table(spark, folder, "lineitem"), live_payload(), {"gamePk": F.col("l_orderkey")})
    polled = landed.select(
        F.lit("feed").alias("provider"),
        F.lit("live").alias("url"),
        "params",
        F.explode(F.array(*[F.lit(f"2024-04-01 19:0{i}:00").cast("timestamp") for i in (0, 1)])).alias("fetched_at"),
        "body",
    )
    polled.write.parquet(bronze)
    live = jobs.live_pitches(jobs.landed_stream(spark, bronze))
    jobs.append(live, target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("gamePk", "atBatIndex", "pitchIndex")


@query("""
select event_id, user_id, event_type, value from (
  select *, row_number() over (partition by user_id, event_type order by ts desc) as r from events) where r = 1""")
def stream_latest(spark, folder):
    target, checkpoint = _paths(spark, "latest")
    jobs.upsert_latest(
        _events(spark, folder), target, checkpoint, ("user_id", "event_type"), "ts", parts=4
    ).awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")


@query("""
select o_custkey as "gamePk", max(o_orderdate) as seen_at, 1::bigint as inning from orders group by o_custkey""")
def stream_linescore(spark, folder):
    """Orders of a customer are polls of one game; the newest is kept."""
    bronze = scratch_path(spark, "score-bronze")
    target, checkpoint = _paths(spark, "score")
    body = obj(innings=F.array(obj(num=1, home=obj(runs=F.col("o_orderkey") % 9))))
    landed = payloads(table(spark, folder, "orders"), body, {"gamePk": F.col("o_custkey")}, "o_orderdate")
    landed.select(
        F.lit("feed").alias("provider"),
        F.lit("score").alias("url"),
        "params",
        F.col("o_orderdate").cast("timestamp").alias("fetched_at"),
        "body",
    ).write.parquet(bronze)
    jobs.current_linescores(jobs.landed_stream(spark, bronze), target, checkpoint).awaitTermination()
    stored = jobs.linescores(spark, target)
    return stored.select("gamePk", F.col("seen_at").cast("timestamp_ntz").alias("seen_at"), "inning")


@query("""
select c_custkey as "gamePk", 'inning is unreadable' as problem from customer where c_custkey % 4 = 0""")
def stream_rejects(spark, folder):
    """Innings without a readable number are left out of the scores and kept beside them."""
    bronze = scratch_path(spark, "reject-bronze")
    target, checkpoint = _paths(spark, "rejects")
    number = F.when(F.col("c_custkey") % 4 == 0, "first").otherwise("1")
    landed = payloads(table(spark, folder, "customer"), obj(innings=F.array(obj(num=number))), {"gamePk": F.col("c_custkey")})
    at = F.lit("2024-04-01 19:00:00").cast("timestamp")
    landed.select(F.lit("feed").alias("provider"), F.lit("score").alias("url"), "params", at.alias("fetched_at"), "body").write.parquet(bronze)
    jobs.append_rejects(jobs.landed_stream(spark, bronze), LINESCORE, target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("gamePk", F.explode("_problems").alias("problem"))


@query("""
select o_orderkey, o_totalprice, year(o_orderdate)::int as year from orders where year(o_orderdate) in (1996, 1999)""")
def stream_season_refresh(spark, folder):
    root, checkpoint = _paths(spark, "refresh")
    orders = table(spark, folder, "orders")
    stream = jobs.landed_stream(spark, folder, {**ORDER_TYPES}, "orders.parquet")
    jobs.refresh_seasons(
        stream, root, checkpoint, [1996, 1999], lambda: orders, types=ORDER_TYPES, day="o_orderdate",
        cluster=("o_orderdate", "o_orderkey"), **ANY_YEAR,
    ).awaitTermination()
    return pitches.scan_seasons(spark, root, None, ORDER_TYPES, **ANY_YEAR).select("o_orderkey", "o_totalprice", "year")
