"""Season dataset, date ranges and season calendar, on orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugout.operators import boards, seasons
from dugout.operators.typed import canonical_table
from dugout.plans.catalog.base import query, table
from dugout.session import scratch_path
from dugout.sources import pitches, schemas

ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderpriority": "string",
    "o_orderdate": "timestamp_ntz",
}
EVENT_ORDER = ("ts", "event_id")
ANY_YEAR = {"first": 1900, "last": 2100}

CALENDAR_SQL = (
    "calendar(y, first_day, last_day) as (values "
    + ", ".join(f"({y}, date '{a}', date '{b}')" for y, (a, b) in schemas.SEASONS.items())
    + ")"
)
SEASON_EDGES_SQL = """
  coalesce(first_day, make_date(yy, 3, 15)) as opening, coalesce(last_day, make_date(yy, 11, 15)) as closing"""


@query("""
select event_type, count(*) as pitch_count, round(avg(value), 1) as avg_velocity,
       round(count(*) * 100.0::double / sum(count(*)) over (), 1) as usage_pct
from events group by event_type""")
def pitch_mix(spark, folder):
    return boards.pitch_mix(table(spark, folder, "events"), "event_type", "value")


def _years(orders):
    edges = orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return list(range(edges[0], edges[1] + 1))


def _order_seasons(spark, folder, name):
    orders = table(spark, folder, "orders")
    root = scratch_path(spark, name)
    years = _years(orders)
    options = dict(types=ORDER_TYPES, day="o_orderdate", cluster=("o_orderdate", "o_orderkey"), **ANY_YEAR)
    return orders, root, years, options


@query("""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate, year(o_orderdate)::int as year
from orders where year(o_orderdate) in (1996, 1997)""")
def partition_scan(spark, folder):
    orders, root, years, options = _order_seasons(spark, folder, "seasons")
    pitches.write_seasons(orders, root, years, **options)
    return pitches.scan_seasons(spark, root, [1996, 1997], ORDER_TYPES, **ANY_YEAR)


@query("""
with y as (select distinct year(o_orderdate)::int as season from orders)
select season, season = (select max(season) from y) as written from y""")
def partition_sync_skip(spark, folder):
    orders, root, years, options = _order_seasons(spark, folder, "skip")
    pitches.write_seasons(orders, root, years[:-1], **options)
    return pitches.write_seasons(orders, root, years, **options).drop("path")


@query("""
select o_orderkey, o_custkey, o_orderstatus,
       case when year(o_orderdate) = 1996 then -o_totalprice else o_totalprice end as o_totalprice,
       o_orderpriority, o_orderdate, year(o_orderdate)::int as year
from orders""")
def partition_force(spark, folder):
    orders, root, years, options = _order_seasons(spark, folder, "force")
    pitches.write_seasons(orders, root, years, **options)
    changed = orders.withColumn("o_totalprice", -F.col("o_totalprice"))
    pitches.write_seasons(changed, root, 1996, force=True, **options)
    return pitches.scan_seasons(spark, root, None, ORDER_TYPES, **ANY_YEAR)


@query("select o_orderkey, o_orderstatus as game_date from orders where o_orderkey % 7 = 0")
def season_rejects(spark, folder):
    """Rows whose date cannot be read are named, not dropped."""
    day = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderstatus")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    landed = table(spark, folder, "orders").select("o_orderkey", day.alias("game_date"))
    return pitches.season_rejects(landed)


@query("select distinct year(o_orderdate)::int as season from orders")
def stored_seasons(spark, folder):
    orders, root, years, options = _order_seasons(spark, folder, "stored")
    pitches.write_seasons(orders, root, years, **options)
    stored = pitches.stored_seasons(spark, root)
    return spark.createDataFrame([(s,) for s in stored], "season int")


@query("""
select try_cast(o_orderstatus as double) as o_totalprice, o_orderkey, o_custkey, o_orderpriority,
       null::varchar as o_orderstatus, null::timestamp as o_orderdate, o_totalprice as extra
from orders""")
def canonical_normalize(spark, folder):
    orders = table(spark, folder, "orders")
    landed = orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("int").alias("o_custkey"),
        F.col("o_orderstatus").alias("o_totalprice"),
        "o_orderpriority",
        F.col("o_totalprice").alias("extra"),
    )
    return canonical_table(landed, ORDER_TYPES)


@query("select * from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-13'")
def range_query(spark, folder):
    events = table(spark, folder, "events")
    return pitches.pitches_between(
        events, "2024-01-12", "2024-01-05", day="ts", order=EVENT_ORDER, in_season_only=False
    )


@query(f"""
with {CALENDAR_SQL},
shifted as (select o_orderkey, (o_orderdate + interval 168 month)::date as game_date from orders),
edged as (select s.*, year(game_date) as yy, first_day, last_day from shifted s left join calendar on y = year(game_date))
select o_orderkey, game_date::varchar as game_date from edged
where game_date between date '2010-02-01' and date '2013-06-30'
  and game_date between coalesce(first_day, make_date(yy, 3, 15)) and coalesce(last_day, make_date(yy, 11, 15))""")
def range_in_season(spark, folder):
    games = _shifted(table(spark, folder, "orders")).select("o_orderkey", F.col("game_date").cast("string").alias("game_date"))
    return pitches.pitches_between(games, "2010-02-01", "2013-06-30", order=("game_date", "o_orderkey"))


def _shifted(orders):
    """Orders moved 14 years on, so that known and unknown seasons both occur."""
    return orders.select("o_orderkey", "o_custkey", F.add_months(F.to_date("o_orderdate"), 168).alias("game_date"))


@query("select * from events where user_id = 7 and ts >= timestamp '2024-01-03' and ts < timestamp '2024-02-01'")
def player_query(spark, folder):
    events = table(spark, folder, "events")
    return pitches.player_pitches(events, 7, "2024-01-03", "2024-01-31", "user_id", "ts", EVENT_ORDER)


@query("select * from lineitem where l_orderkey = 77")
def game_query(spark, folder):
    return pitches.game_pitches(table(spark, folder, "lineitem"), 77, "l_orderkey", ("l_shipdate", "l_linenumber"))


@query("select * from events")
def pitch_sort(spark, folder):
    return pitches.sort_pitches(table(spark, folder, "events"), ("ts", "user_id", "event_id"))


@query(f"""
with {CALENDAR_SQL},
span as (select o_custkey, min((o_orderdate + interval 168 month)::date) as a, max((o_orderdate + interval 168 month)::date) as b
         from orders group by o_custkey),
years as (select span.*, unnest(generate_series(year(a), year(b))) as yy from span),
edged as (select o_custkey, a, b, {SEASON_EDGES_SQL} from years left join calendar on y = yy),
run as (select o_custkey, b, greatest(opening, a) as lo, least(closing, b) as hi from edged),
chunk as (select o_custkey, b, unnest(generate_series(lo::timestamp, hi::timestamp, interval 7 day))::date as chunk_start
          from run where lo <= hi)
select o_custkey, chunk_start, least(chunk_start + 6, b) as chunk_end from chunk""")
def season_chunks(spark, folder):
    dated = _shifted(table(spark, folder, "orders"))
    spans = dated.groupBy("o_custkey").agg(F.min("game_date").alias("first_day"), F.max("game_date").alias("last_day"))
    return seasons.season_chunks(spans, "first_day", "last_day").select("o_custkey", "chunk_start", "chunk_end")


@query(f"""
with {CALENDAR_SQL},
shifted as (select o_orderkey, (o_orderdate + interval 168 month)::date as game_date from orders)
select o_orderkey, game_date from shifted left join calendar on y = year(game_date)
where game_date between coalesce(first_day, make_date(year(game_date), 3, 15))
                    and coalesce(last_day, make_date(year(game_date), 11, 15))""")
def in_season(spark, folder):
    dated = _shifted(table(spark, folder, "orders"))
    return dated.where(seasons.in_season(F.col("game_date"))).select("o_orderkey", "game_date")
