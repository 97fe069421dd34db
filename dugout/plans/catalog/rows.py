"""Filters and row-level rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugout.functions import clean, codes, statcols
from dugout.operators import boards, filters, ranks
from dugout.operators.typed import prefixed, rename_present, with_singles
from dugout.plans.catalog.base import query, table


@query("select * from part where p_size > 20 and p_retailprice >= 950 and p_brand != 'Brand#13'")
def stat_filters(spark, folder):
    part = table(spark, folder, "part")
    return filters.stat_filter(
        part, [("p_size", ">", 20), ("p_retailprice", ">=", "950"), filters.rule("p_brand", "!=", "Brand#13")]
    )


@query("select * from lineitem where l_quantity < 10 and l_discount != 0.05 and l_returnflag = 'R'")
def filter_rules_table(spark, folder):
    rules = filters.parse_filters("l_quantity,lt,10|l_discount,ne,0.05|l_returnflag,eq,R")
    assert filters.parse_filters(filters.format_filters(rules)) == rules
    return filters.stat_filter(table(spark, folder, "lineitem"), rules)


_CLIPS_SQL = """
select * from events
where event_type in ('purchase', 'error') and value >= 10 and value <= 90
order by ts desc, event_id desc limit 50"""


def _clips(spark, folder, page):
    return filters.clip_search(
        table(spark, folder, "events"),
        {"event_type": ["purchase", "error"]},
        {"value": (10, 90)},
        ("ts", "event_id"),
        limit=50,
        page=page,
    )


@query(_CLIPS_SQL)
def clip_search(spark, folder):
    return _clips(spark, folder, 1)


@query(_CLIPS_SQL + " offset 100")
def clip_search_page(spark, folder):
    return _clips(spark, folder, 3)


_STATS = """
with s as (select l_suppkey, year(l_shipdate)::int as season, l_quantity::decimal(18,2) as qty,
                  l_extendedprice::decimal(18,2) as price, l_linestatus from lineitem)"""


def _season_stats(spark, folder, by, **options):
    lines = table(spark, folder, "lineitem")
    typed = lines.select(
        "l_suppkey",
        "l_returnflag",
        "l_linestatus",
        F.year("l_shipdate").alias("season"),
        F.col("l_quantity").cast("decimal(18,2)").alias("qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    board = boards.season_stats(typed, (1996, 1999), ["qty", "price"], by, **options)
    return board.withColumns({c: F.col(c).cast("double") for c in ("qty", "price")})


@query(_STATS + """
select l_suppkey, season, sum(qty)::double as qty, sum(price)::double as price, count(*) as n_rows
from s where season between 1996 and 1999 and l_linestatus = 'O' group by all having sum(qty) >= 100""")
def season_stats_split(spark, folder):
    return _season_stats(
        spark, folder, ["l_suppkey"], wanted={"l_linestatus": ["O"]}, qualify=("qty", 100)
    )


@query(_STATS + """
select l_suppkey, sum(qty)::double as qty, sum(price)::double as price, count(*) as n_rows
from s where season between 1996 and 1999 group by all""")
def season_stats_merged(spark, folder):
    return _season_stats(spark, folder, ["l_suppkey"], split_seasons=False)


@query("""
with s as (select l_returnflag, year(l_shipdate)::int as season, l_quantity::decimal(18,2) as qty,
                  l_extendedprice::decimal(18,2) as price from lineitem)
select l_returnflag, season, sum(qty)::double as qty, sum(price)::double as price, count(*) as n_rows
from s where season between 1996 and 1999 and price between 1000 and 50000 group by all""")
def season_stats_team(spark, folder):
    return _season_stats(spark, folder, ["l_returnflag"], bounds={"price": (1000, 50000)})


@query("""
with s as (select l_suppkey::varchar as "Name", 'T' || l_suppkey % 5 as "Team", year(l_shipdate)::int as "Season", l_quantity::bigint as "H",
                  l_linenumber::bigint as "HR", l_suppkey % 3 as c, case when l_returnflag = 'A' then 'al' else 'nl' end as lg, month(l_shipdate) as m,
                  case when l_linestatus = 'O' then 'ss' else 'of' end as pos from lineitem)
select "Name", "Team", "Season", sum("HR")::bigint as "HR", sum("H")::bigint as "H" from s
where "Season" between 1994 and 1997 and c = 0 and lg = 'nl' and m = 6 and pos = 'of' group by all""")
def season_stats_columns(spark, folder):
    """Columns by name, alias and the word for the common ones, of a scope checked by its codes."""
    key = F.col("l_suppkey")
    category = F.when(key % 3 == 0, "bat").when(key % 3 == 1, "pit").otherwise("fld")
    stats = table(spark, folder, "lineitem").select(
        key.cast("string").alias("Name"),
        F.concat(F.lit("T"), (key % 5).cast("string")).alias("Team"),
        F.year("l_shipdate").alias("Season"),
        F.col("l_quantity").cast("bigint").alias("H"),
        F.col("l_linenumber").cast("bigint").alias("HR"),
        category.alias("category"),
        F.when(F.col("l_returnflag") == "A", "al").otherwise("nl").alias("league"),
        F.month("l_shipdate").alias("month"),
        F.when(F.col("l_linestatus") == "O", "ss").otherwise("of").alias("position"),
    )
    scope = boards.stat_scope("bat", "nl", "june", "of")
    board = boards.season_stats(stats, (1994, 1997), ["H", "HR"], ["Name", "Team"], season="Season", wanted=scope)
    return statcols.stat_columns("bat").project(board, ["home_runs", "name", "Hits"])


_NAMED = """
with n as (select c_custkey, case when c_custkey % 11 = 0 then null when c_custkey % 7 = 0 then '  ' else c_name end as player_name,
                  case when c_custkey % 13 = 0 then 999999 when c_custkey % 17 = 0 then null else c_custkey end as player_id
           from customer)"""


def _named(spark, folder):
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(key % 11 == 0, None).when(key % 7 == 0, "  ").otherwise(F.col("c_name")).alias("player_name"),
        F.when(key % 13 == 0, 999999).when(key % 17 == 0, None).otherwise(key).alias("player_id"),
    )


@query(_NAMED + " select * from n where trim(player_name) != '' and player_id != 999999")
def named_rows(spark, folder):
    return filters.named_players(_named(spark, folder))


@query(_NAMED + " select * from n where trim(player_name) != ''")
def named_rows_only(spark, folder):
    return filters.named_players(_named(spark, folder), player_id=None)


@query(_NAMED + " select * from n where player_id is not null or trim(player_name) is not null and player_name != '  '")
def any_key(spark, folder):
    rows = _named(spark, folder).withColumn("_name", F.nullif(F.trim("player_name"), F.lit("")))
    return filters.any_present(rows, ["player_id", "_name"]).drop("_name")


@query(_NAMED + " select c_custkey, coalesce(player_id, -1) as player_id from n")
def sentinel(spark, folder):
    rows = _named(spark, folder)
    return rows.select("c_custkey", clean.id_or_sentinel(F.col("player_id")).alias("player_id"))


@query("""
select o_orderkey, case when o_orderstatus = 'F' then 'CB-A' else substr(o_orderpriority, 1, 1) end as round, o_custkey as "teamId"
from orders where o_orderstatus != 'F' and substr(o_orderpriority, 1, 1) = '2'""")
def lenient_round_filter(spark, folder):
    picks = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "CB-A").otherwise(F.substring("o_orderpriority", 1, 1)).alias("round"),
        F.col("o_custkey").alias("teamId"),
    )
    return filters.draft_round(picks, 2)


@query("""
select s_suppkey, 2020 + s_suppkey % 5 as "yearID", case when s_nationkey % 2 = 0 then 'AL' else 'NL' end as "lgID"
from supplier where s_suppkey % 5 = 3 and s_nationkey % 2 = 0""")
def team_seasons(spark, folder):
    teams = table(spark, folder, "supplier").select(
        "s_suppkey",
        (F.col("s_suppkey") % 5 + 2020).alias("yearID"),
        F.when(F.col("s_nationkey") % 2 == 0, "AL").otherwise("NL").alias("lgID"),
    )
    return filters.team_seasons(teams, 2023, "al")


def _games(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("string").alias("season"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("officialDate"),
        (F.col("o_custkey") % 30).alias("homeTeamId"),
        (F.col("o_orderkey") % 30).alias("awayTeamId"),
        F.col("o_orderstatus").alias("gameType"),
    )


_GAMES = """
with g as (select o_orderkey, year(o_orderdate)::varchar as season, strftime(o_orderdate, '%Y-%m-%d') as "officialDate",
                  o_custkey % 30 as "homeTeamId", o_orderkey % 30 as "awayTeamId", o_orderstatus as "gameType" from orders)"""


@query(_GAMES + """ select * from g where season = '1998' and ("homeTeamId" = 4 or "awayTeamId" = 4)""")
def schedule_query(spark, folder):
    return filters.scheduled(_games(spark, folder), season=1998, team=4)


@query(_GAMES + """ select * from g where season = '1997' and "gameType" = 'P'""")
def postseason_query(spark, folder):
    return filters.scheduled(_games(spark, folder), season=1997, postseason=True)


@query("""
with g as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as date from orders)
select * from g where date between '1996-02-01' and '1996-03-15'""")
def transactions_query(spark, folder):
    moves = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")
    )
    return filters.moves(moves, start="1996-02-01", end="1996-03-15")


@query("""
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as date, (o_custkey % 3)::int as "sportId" from orders
where o_orderdate = date '1996-02-01' and o_custkey % 3 = 1""")
def transactions_day(spark, folder):
    moves = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), (F.col("o_custkey") % 3).cast("int").alias("sportId")
    )
    return filters.moves(moves, date="1996-02-01", sport=1)


@query("""
with r as (select c_custkey, c_nationkey::bigint as "teamId", 2020 + c_custkey % 3 as season,
                  ['active','full','40Man'][(1 + c_custkey % 2)::int] as "rosterType" from customer)
select * from r where "teamId" = 5 and season = 2022 and "rosterType" = 'full'""")
def roster_query(spark, folder):
    kinds = F.array(F.lit("active"), F.lit("full"), F.lit("40Man"))
    members = table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_nationkey").cast("bigint").alias("teamId"),
        (F.col("c_custkey") % 3 + 2020).alias("season"),
        F.get(kinds, (F.col("c_custkey") % 2).cast("int")).alias("rosterType"),
    )
    return filters.roster(members, 5, 2022, "FULL")


@query("""
select p_partkey, ['LF','Left Field','7','CF','C'][(1 + p_partkey % 5)::int] as pos from part where p_partkey % 5 in (0, 1, 2)""")
def position_filter(spark, folder):
    names = F.array(*[F.lit(v) for v in ("LF", "Left Field", "7", "CF", "C")])
    fielders = table(spark, folder, "part").select(
        "p_partkey", F.get(names, (F.col("p_partkey") % 5).cast("int")).alias("pos")
    )
    return filters.positioned(fielders, "LF")


@query("select s_suppkey, s_nationkey - 3 as venue_id from supplier where s_nationkey - 3 in (2, 5, 11)")
def venue_filter(spark, folder):
    parks = table(spark, folder, "supplier").select("s_suppkey", (F.col("s_nationkey") - 3).alias("venue_id"))
    return filters.at_venues(parks, [2, 5, 11])


@query("select s_suppkey, s_nationkey - 3 as venue_id from supplier where s_nationkey > 3")
def valid_venues(spark, folder):
    parks = table(spark, folder, "supplier").select("s_suppkey", (F.col("s_nationkey") - 3).alias("venue_id"))
    return filters.at_venues(parks, None)


@query("""
select event_id, case when event_type = 'error' then null else value end as hc_x,
       case when user_id % 5 = 0 then null else user_id::double end as hc_y
from events where event_type != 'error' and user_id % 5 != 0""")
def located_rows(spark, folder):
    hits = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("hc_x"),
        F.when(F.col("user_id") % 5 != 0, F.col("user_id").cast("double")).alias("hc_y"),
    )
    return filters.located(hits)


@query("""
with g as (select o_orderkey, case when o_orderkey % 25 = 0 then 'Gtm' when o_orderkey % 40 = 1 then null
                                   else o_orderkey::varchar end as "Game",
                  case when o_orderstatus = 'F' then '@' end as "Home" from orders)
select o_orderkey, "Game", "Home" is null as "Home" from g where "Game" != 'Gtm'""")
def header_rows(spark, folder):
    key = F.col("o_orderkey")
    log = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 25 == 0, "Gtm").when(key % 40 == 1, None).otherwise(key.cast("string")).alias("Game"),
        F.when(F.col("o_orderstatus") == "F", "@").alias("Home"),
    )
    return filters.without_header_rows(log, "Game", "Gtm").withColumn("Home", F.col("Home").isNull())


@query("""
select l_orderkey as "batting.id", l_quantity as "batting.H", l_linenumber::double as "batting.2B", 1.0::double as "batting.3B",
       0.0::double as "batting.HR", l_quantity - l_linenumber - 1.0 - 0.0 as "batting.1B" from lineitem""")
def home_flag(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("key"),
        F.col("l_quantity").alias("H"),
        F.col("l_linenumber").cast("double").alias("2B"),
        F.lit(1.0).alias("3B"),
        F.lit(0.0).alias("HR"),
    )
    return prefixed(with_singles(rename_present(lines, {"key": "id", "absent": "x"})), "batting.")


@query("select n_nationkey, n_name, n_regionkey from nation")
def multi_sort(spark, folder):
    return ranks.sorted_by(table(spark, folder, "nation"), ["n_regionkey", "n_name"], [False, True])


@query("""
with m as (select l_orderkey, max(l_linenumber) as top from lineitem group by all)
select l.l_orderkey, l.l_linenumber, l.l_partkey from lineitem l join m using (l_orderkey) where l_linenumber < top""")
def drop_last(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return ranks.without_last(lines, ["l_orderkey"], "l_linenumber")


@query("select * from lineitem where l_returnflag in ('A', 'N') and l_discount is not null and l_tax > 0")
def membership_filter(spark, folder):
    lines = table(spark, folder, "lineitem")
    flags = F.col("l_returnflag").isin("A", "N")
    return lines.where(filters.all_of([flags, F.col("l_discount").isNotNull(), F.col("l_tax") > 0]))


@query("""
select p_partkey, case p_partkey % 4 when 0 then 'SI' when 1 then 'CU' when 2 then 'FF' end as code
from part""")
def pitch_codes(spark, folder):
    names = F.array(*[F.lit(v) for v in ("Sinker", "curveball", "ff", "nothing")])
    thrown = F.get(names, (F.col("p_partkey") % 4).cast("int"))
    return table(spark, folder, "part").select("p_partkey", codes.pitch_code_column(thrown).alias("code"))
