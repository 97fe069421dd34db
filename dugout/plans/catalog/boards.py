"""Aggregated boards, ranks and latest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugout.operators import boards, ranks
from dugout.plans.catalog.base import exact_sum, payloads, query, table
from dugout.plans.clips import best_mp4, first_hls, playback_list
from dugout.plans.probe import GRADES, grade, grade_pairs
from dugout.sources.payloads import latest_payloads


@query("select user_id, round(avg(value), 6) as avg_value from events where event_type = 'click' group by user_id")
def mean_by_player(spark, folder):
    clicks = table(spark, folder, "events").where("event_type = 'click'")
    return boards.mean_by(clicks, ["user_id"], "value", "avg_value", digits=6)


@query("""
select l_suppkey, max(l_extendedprice) as max_velocity from lineitem where l_returnflag in ('A', 'R')
group by l_suppkey order by max_velocity desc, l_suppkey limit 5""")
def max_topk(spark, folder):
    lines = table(spark, folder, "lineitem")
    return boards.fastest(lines, 5, "l_suppkey", "l_returnflag", "l_extendedprice", ("A", "R"))


@query("""
select l_returnflag, l_linestatus, count(*) as n from lineitem where l_linestatus is not null group by all""")
def outcome_counts(spark, folder):
    return boards.outcome_counts(table(spark, folder, "lineitem"), ("l_returnflag", "l_linestatus"), "l_linestatus")


@query("""
with s as (select l_suppkey, sum(l_tax::decimal(18,2))::double as a, sum(l_discount::decimal(18,2))::double as b from lineitem group by 1)
select l_suppkey, round(a / nullif(b, 0), 6) as ratio from s order by ratio desc nulls last, l_suppkey limit 20""")
def ratio_rank(spark, folder):
    lines = table(spark, folder, "lineitem")
    sums = lines.groupBy("l_suppkey").agg(exact_sum("l_tax").alias("tax"), exact_sum("l_discount").alias("discount"))
    return boards.ratio_leaders(sums, ["l_suppkey"], "tax", "discount", "ratio", 20, digits=6)


@query("""
select l_suppkey, count(*) as batted_balls, round(avg(l_quantity), 6) as avg_speed, max(l_quantity) as max_speed,
       round(avg(l_discount), 6) as avg_angle, round(avg(l_extendedprice), 4) as avg_distance, max(l_extendedprice) as max_distance,
       count(*) filter (l_quantity >= 45) as hard_hits,
       count(*) filter (l_quantity >= 45)::double / count(*) as hard_hit_share
from lineitem group by l_suppkey having count(*) >= 50""")
def board_exit_velo(spark, folder):
    board = boards.exit_velocity(
        table(spark, folder, "lineitem"), ["l_suppkey"], 50, "l_quantity", "l_discount", "l_extendedprice", 45.0
    )
    return board.withColumns(
        {
            "avg_speed": F.round("avg_speed", 6),
            "avg_angle": F.round("avg_angle", 6),
            "avg_distance": F.round("avg_distance", 4),
        }
    )


@query("""
select l_suppkey, count(*) as pa, round(avg(l_discount), 6) as est_ba, round(avg(l_tax), 6) as est_woba,
       sum(l_quantity) / nullif(sum(l_linenumber::double), 0) as woba
from lineitem group by l_suppkey having count(*) >= 20""")
def board_expected(spark, folder):
    plate = table(spark, folder, "lineitem").select(
        "l_suppkey",
        F.col("l_returnflag").alias("events"),
        F.col("l_discount").alias("estimated_ba_using_speedangle"),
        F.col("l_tax").alias("estimated_woba_using_speedangle"),
        F.col("l_quantity").alias("woba_value"),
        F.col("l_linenumber").cast("double").alias("woba_denom"),
    )
    board = boards.expected_stats(plate, ["l_suppkey"], 20)
    return board.withColumns({c: F.round(c, 6) for c in ("est_ba", "est_woba")})


@query("""
select l_suppkey, round(avg(l_quantity) filter (l_returnflag = 'A'), 6) as "A", round(avg(l_quantity) filter (l_returnflag = 'N'), 6) as "N",
       round(avg(l_quantity) filter (l_returnflag = 'R'), 6) as "R"
from lineitem group by l_suppkey having count(*) >= 550""")
def board_arsenal_pivot(spark, folder):
    wide = boards.arsenal_wide(
        table(spark, folder, "lineitem"), "avg_speed", ["l_suppkey"], 550, "l_returnflag", "l_quantity", types=("A", "N", "R")
    )
    return wide.withColumns({c: F.round(c, 6) for c in ("A", "N", "R")})


@query("""
with c as (select user_id, event_type, count(*) as pitches, round(avg(value), 6) as avg_speed, round(avg(user_id), 6) as avg_result
           from events group by all)
select *, pitches * 100.0::double / sum(pitches) over (partition by user_id) as pitch_usage from c""")
def board_arsenal_stats(spark, folder):
    board = boards.arsenal_stats(
        table(spark, folder, "events"), ["user_id"], 1, "event_type", "value", "user_id"
    )
    return board.withColumns({c: F.round(c, 6) for c in ("avg_speed", "avg_result")})


@query("""
select l_suppkey, count(*) as pitches, round(avg(l_discount), 6) as avg_break_x, round(avg(l_tax), 6) as avg_break_z
from lineitem where l_returnflag = 'R' group by l_suppkey having count(*) >= 10""")
def board_movement(spark, folder):
    board = boards.movement(
        table(spark, folder, "lineitem"), "R", ["l_suppkey"], 10, "l_returnflag", "l_discount", "l_tax"
    )
    return board.withColumns({c: F.round(c, 6) for c in ("avg_break_x", "avg_break_z")})


@query("""
select l_suppkey, count(*) as swings, round(avg(l_quantity), 6) as avg_bat_speed, round(avg(l_discount), 6) as avg_swing_length
from lineitem where l_linestatus = 'O' group by l_suppkey having count(*) >= 10""")
def board_bat_tracking(spark, folder):
    swings = table(spark, folder, "lineitem").select(
        "l_suppkey",
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).alias("bat_speed"),
        F.col("l_discount").alias("swing_length"),
    )
    board = boards.bat_tracking(swings, ["l_suppkey"], 10)
    return board.withColumns({c: F.round(c, 6) for c in ("avg_bat_speed", "avg_swing_length")})


@query("""
with c as (select l_suppkey, count(*) filter (l_returnflag = 'A') as n_a, count(*) filter (l_returnflag = 'R') as n_b,
  avg(l_quantity) filter (l_returnflag = 'A') as a, avg(l_quantity) filter (l_returnflag = 'R') as b
  from lineitem where l_returnflag in ('A', 'R') group by 1)
select l_suppkey, n_a, n_b, round(a, 6) as axis_a, round(b, 6) as axis_b, round(a - b, 6) as axis_difference from c where n_a >= 5 and n_b >= 5""")
def board_spin(spark, folder):
    pitch = F.when(F.col("l_returnflag") == "A", "FF").when(F.col("l_returnflag") == "R", "CH").otherwise("SL")
    pitches = table(spark, folder, "lineitem").select("l_suppkey", pitch.alias("pitch_type"), F.col("l_quantity").alias("spin_axis"))
    board = boards.spin_comparison(pitches, "4-Seamer", "Changeup", ["l_suppkey"], 5)
    return board.withColumns({c: F.round(c, 6) for c in ("axis_a", "axis_b", "axis_difference")})


@query("""
with v as (select s_suppkey as venue_id, s_name as venue_name, null::bigint as team_id, null::varchar as x, 2020 + s_suppkey % 3 as year,
                  s_nationkey::bigint as f from supplier where s_suppkey > 0)
select venue_id, venue_name, year, f as park_factor, f as woba_factor, f * 2 as hr_factor from v where venue_id in (5, 7, 9, 11)""")
def board_park_factors(spark, folder):
    landed = table(spark, folder, "supplier").selectExpr(
        "cast(s_suppkey as string) as venue_id",
        "s_name as venue_name",
        "cast(2020 + s_suppkey % 3 as string) as key_year",
        "cast(s_nationkey as string) as index_woba",
        "cast(s_nationkey * 2 as string) as index_hr",
    )
    return boards.park_factors(landed, [5, 7, 9, 11])


@query("""
with s as (select l_suppkey, l_linenumber, l_partkey, l_orderkey, year(l_shipdate)::int as year, case when l_returnflag = 'R' and year(l_shipdate) >= 1998 then 'spin-based' else 'observed' end as spin_type from lineitem)
select * from s where spin_type = 'spin-based' or year not in (select year from s where spin_type = 'spin-based')""")
def board_active_spin(spark, folder):
    year = F.year("l_shipdate")
    better = (F.col("l_returnflag") == "R") & (year >= 1998)
    landed = table(spark, folder, "lineitem").select(
        "l_suppkey",
        "l_linenumber",
        "l_partkey",
        "l_orderkey",
        year.alias("year"),
        F.when(better, "spin-based").otherwise("observed").alias("spin_type"),
    )
    return boards.active_spin(landed)


@query("""
select c_custkey, c_mktsegment, c_acctbal, percent_rank() over (partition by c_mktsegment order by c_acctbal) as percent_rank
from customer""")
def percentile(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return ranks.percent_ranks(customers, ["c_mktsegment"], "c_acctbal")


@query("""
select l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity,
       percent_rank() over (partition by l_returnflag order by l_quantity) as percent_rank from lineitem""")
def percentile_ties(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    return ranks.percent_ranks(lines, ["l_returnflag"], "l_quantity")


_TEN = ", ".join(f"percent_rank() over (partition by l_returnflag order by (l_partkey + {i} * l_suppkey) % {97 + i}) as r{i}" for i in range(10))


@query(f"select l_orderkey, l_linenumber, {_TEN} from lineitem")
def percentile_many(spark, folder):
    """Ten metrics ranked in one pass."""
    metrics = [f"(l_partkey + {i} * l_suppkey) % {97 + i} as m{i}" for i in range(10)]
    lines = table(spark, folder, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_returnflag", *metrics)
    ranked = ranks.percent_ranks_of(lines, ["l_returnflag"], {f"m{i}": f"r{i}" for i in range(10)})
    return ranked.select("l_orderkey", "l_linenumber", *[f"r{i}" for i in range(10)])


@query("""
with b as (select c_custkey as player_id, c_name as player_name, c_nationkey as year, c_acctbal as ev, c_custkey % 37 as xba from customer where c_custkey != 999999)
select *, percent_rank() over (partition by year order by ev) * 100.0 as ev_percentile,
       percent_rank() over (partition by year order by xba) * 100.0 as xba_percentile from b""")
def percentile_board(spark, folder):
    board = table(spark, folder, "customer").selectExpr(
        "c_custkey as player_id", "c_name as player_name", "c_nationkey as year", "c_acctbal as ev", "c_custkey % 37 as xba"
    )
    return boards.percentile_board(board, ["ev", "xba"])


@query("""
select * from (select c_custkey, c_mktsegment, c_acctbal, rank() over (partition by c_mktsegment order by c_acctbal desc) as rank from customer)
where rank <= 3""")
def leaders_topn(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return ranks.leaders(customers, ["c_mktsegment"], [F.desc("c_acctbal")], 3)


@query("select l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber limit 10")
def top_metric(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ranks.top(lines, [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 10)


@query("""
select event_type, user_id, event_id, value from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as r from events) where r = 1""")
def latest_payload(spark, folder):
    events = table(spark, folder, "events").select("event_type", "user_id", "event_id", "value", "ts")
    return ranks.latest(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("""
select url, body, user_id from (
  select 'https://feed/' || event_type as url, user_id, event_id::varchar as body,
         row_number() over (partition by event_type, user_id order by ts desc) as r, ts from events)
where r = 1 and ts >= timestamp '2024-01-30 12:00:00' - interval 6 day""")
def fresh_payload(spark, folder):
    landed = table(spark, folder, "events").select(
        F.lit("feed").alias("provider"),
        F.concat(F.lit("https://feed/"), F.col("event_type")).alias("url"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("params"),
        F.col("ts").alias("fetched_at"),
        F.col("event_id").cast("string").alias("body"),
        "user_id",
    )
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return latest_payloads(landed, "6 days", now).select("url", "body", "user_id")


_GAMES = """
with g as (select n_regionkey as division, n_name as team, o_orderstatus = 'F' as won from orders
           join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
t as (select division, team, count(*) filter (won) as "W", count(*) filter (not won) as "L" from g group by all),
p as (select *, "W"::double / nullif("W" + "L", 0) as "W-L%" from t),
r as (select *, row_number() over (partition by division order by "W-L%" desc, "W" desc, team) as n from p)
select p.division, p.team, p."W", p."L", p."W-L%", ((l."W" - p."W") + (p."L" - l."L")) / 2.0::double as "GB"
from p join (select * from r where n = 1) l on l.division = p.division"""


@query(_GAMES)
def standings(spark, folder):
    orders, customers, nations = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    games = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    played = games.select(
        F.col("n_regionkey").alias("division"), F.col("n_name").alias("team"), (F.col("o_orderstatus") == "F").alias("won")
    )
    return boards.standings(played)


@query("""
with s as (select l_orderkey % 30 as home, (l_partkey % 30) as away, l_quantity as hs, l_linenumber * 5.0 as vs from lineitem),
g as (select home as team, hs > vs as won from s where hs != vs union all select away, vs > hs from s where hs != vs)
select team, count(*) filter (won) as wins, count(*) as games from g group by team""")
def team_results(spark, folder):
    log = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey % 30 as home_team",
        "l_partkey % 30 as visiting_team",
        "l_quantity as home_score",
        "l_linenumber * 5.0D as visiting_score",
    )
    results = boards.team_results(log)
    return results.groupBy("team").agg(F.count_if("won").alias("wins"), F.count(F.lit(1)).alias("games"))


@query("""
with d as (select event_type as profile, ts::date as day, count(*)::double as wall from events group by all),
last as (select max(day) as day from d),
h as (select profile, count(*) as n, avg(wall) as m, stddev_samp(wall) as s from d, last where d.day < last.day group by profile),
c as (select profile, wall from d, last where d.day = last.day)
select c.profile, wall as current_value, round(case when n >= 2 then m else wall end, 6) as baseline_mean,
       round(case when n >= 2 then s else 0 end, 6) as baseline_std,
       round(case when n >= 2 and s != 0 then (wall - m) / s when n >= 2 then wall - m else 0 end, 6) as sigma,
       coalesce(case when n >= 2 and s != 0 then (wall - m) / s when n >= 2 then wall - m else 0 end > 1.0, false) as is_regression
from c left join h using (profile)""")
def regression_check(spark, folder):
    daily = (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("profile"), F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).cast("double").alias("wall"))
    )
    last = daily.agg(F.max("day")).scalar()
    checked = boards.regression_check(
        daily.where(F.col("day") < last), daily.where(F.col("day") == last), metric="wall", sigma=1.0
    )
    rounded = ("baseline_mean", "baseline_std", "sigma")
    return checked.withColumnRenamed("wall", "current_value").withColumns({c: F.round(c, 6) for c in rounded})


@query("""
with c as (select o_orderkey, (o_orderkey % 3000)::bigint as a, (o_custkey % 3000)::bigint as b, 'u' || o_orderkey as id from orders),
r as (select *, case a when 4 then 4000 else a end as ra, case b when 4 then 4000 else b end as rb from c)
select o_orderkey, id || case when ra >= rb then '_a_' || a else '_b_' || b end || 'K.mp4' as mp4, null::varchar as none,
       case when o_orderkey % 2 = 0 then id || '.m3u8' end as hls, greatest(ra, rb) as bitrate from r""")
def best_playback(spark, folder):
    orders = table(spark, folder, "orders")
    key, name = F.col("o_orderkey"), F.concat(F.lit("u"), F.col("o_orderkey").cast("string"))
    rate = lambda c: (F.col(c) % 3000).cast("string")
    file = lambda tag, c: F.concat(name, F.lit(f"_{tag}_"), rate(c), F.lit("K.mp4"))
    entry = lambda n, u: F.struct(n.alias("name"), u.alias("url"))
    landed = payloads(
        orders,
        F.struct(
            F.array(
                entry(F.lit("poster"), F.lit(None).cast("string")),
                entry(F.concat(F.lit("mp4 "), rate("o_orderkey"), F.lit("K")), file("a", "o_orderkey")),
                entry(F.lit("hls"), F.when(key % 2 == 0, F.concat(name, F.lit(".m3u8")))),
                entry(F.lit(""), file("b", "o_custkey")),
            ).alias("playbacks")
        ),
        {},
        "o_orderkey",
    )
    raw = landed.select("o_orderkey", F.from_json("body", "playbacks array<string>")["playbacks"].alias("raw"))
    read = raw.select("o_orderkey", playback_list(F.col("raw")).alias("playbacks"))
    best = best_mp4(F.col("playbacks"))
    rates = F.filter("playbacks", lambda p: p["url"] == best)
    return read.select(
        "o_orderkey",
        best.alias("mp4"),
        F.lit(None).cast("string").alias("none"),
        first_hls(F.col("playbacks")).alias("hls"),
        F.try_element_at(rates, F.lit(1))["bitrate"].alias("bitrate"),
    )


_GRADE_NULLS = ", ".join(f"null::bigint as grade_{g}" for g in GRADES if g not in ("hit", "power", "overall", "arm"))


@query(f"""
select o_orderkey, (20 + o_orderkey % 60)::bigint as grade_overall, (20 + o_custkey % 50)::bigint as grade_hit,
       case when o_orderstatus = 'F' then 55::bigint end as grade_power, 40::bigint as grade_arm, {_GRADE_NULLS} from orders""")
def grade_pairs_last(spark, folder):
    key, other = F.col("o_orderkey") % 60 + 20, F.col("o_custkey") % 50 + 20
    report = F.concat(
        F.lit("<p><b>Scouting grades:</b> Hit: 1 | "),
        F.when(F.col("o_orderstatus") == "F", "Power: 55 | ").otherwise(""),
        F.lit("Hit: "), other.cast("string"), F.lit("</b> | ARM: 40 | Makeup: 9 | Overall: "), key.cast("string"), F.lit("</p>"),
    )
    pairs = table(spark, folder, "orders").select("o_orderkey", grade_pairs(report).alias("pairs"))
    return pairs.select("o_orderkey", *[grade(F.col("pairs"), g).alias(f"grade_{g}") for g in GRADES])



@query("""
select l_orderkey, max(l_extendedprice) as best_price, min(l_partkey) filter (l_extendedprice = m) as part
from (select *, max(l_extendedprice) over (partition by l_orderkey) as m from lineitem) group by l_orderkey""")
def best_line(spark, folder):
    """The exploded form of the pick: one aggregate that keeps the first on ties."""
    order = F.struct(F.col("l_extendedprice"), -F.col("l_partkey"))
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_extendedprice").alias("best_price"), F.max_by("l_partkey", order).alias("part")
    )
