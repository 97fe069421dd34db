"""Readers, on tables that Spark first lands as files in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugout.operators.names import ref
from dugout.plans.catalog.base import query, table
from dugout.session import scratch_path
from dugout.sources import archive, files, payloads, schemas

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
_WIDTHS = (2, 3, 5, 4, 6, 6, 11, 6, 5, 3, 3, 2, 3, 4)


@query(
    " union all ".join(
        f"select '{name}' as table_name, count(*) as rows, {width}::int as n_columns from {name}"
        for name, width in zip(TABLES, _WIDTHS, strict=True)
    )
)
def manifest(spark, folder):
    entries = archive.manifest((t, f"{folder}/{t}.parquet", table(spark, folder, t)) for t in TABLES)
    return entries.select("table_name", "rows", "n_columns")


@query()
def manifest_checksums(spark, folder):
    entries = archive.manifest((t, t, table(spark, folder, t)) for t in TABLES)
    return entries.select("table_name", "checksum")


def _land_csv(df, name, header=True):
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", header).option("emptyValue", "").option("nullValue", "").option("escape", '"').csv(path)
    return path


@query("""
select l_orderkey as game_pk, l_linenumber::bigint as inning, case when l_partkey % 5 = 0 then null else l_quantity end as release_speed,
       l_returnflag as pitch_type, l_partkey::varchar as part from lineitem""")
def pitch_csv(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("game_pk"),
        F.col("l_linenumber").alias(" inning"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity").cast("string")).otherwise("fast").alias("release_speed "),
        F.concat(F.lit("  "), F.col("l_returnflag")).alias("pitch_type"),
        F.col("l_partkey").alias("part"),
    )
    return files.read_pitch_csv(spark, _land_csv(lines, "pitch-csv"))


@query("""
select c_name as name_common, c_mktsegment as "mlb_ID", c_custkey::varchar as "player_ID", (2000 + c_nationkey)::bigint as "year_ID",
       'T' as "team_ID", c_custkey % 200 as "G", case when c_custkey % 4 = 0 then null else c_acctbal end as "WAR" from customer""")
def war_csv(spark, folder):
    key = F.col("c_custkey")
    landed = table(spark, folder, "customer").select(
        F.col("c_acctbal").alias("extra"),
        F.when(key % 4 == 0, "NULL").otherwise(F.col("c_acctbal").cast("string")).alias("WAR"),
        F.col("c_name").alias("name_common"),
        F.col("c_mktsegment").alias("mlb_ID"),
        key.alias("player_ID"),
        (F.col("c_nationkey") + 2000).alias("year_ID"),
        F.lit("T").alias("team_ID"),
        (key % 200).alias("G"),
    )
    return files.read_war(spark, _land_csv(landed, "war"))


@query("""
select s_name as "teamID", (2020 + s_suppkey % 5) as "yearID", case when s_nationkey % 2 = 0 then 'AL' else 'NL' end as "lgID"
from supplier where s_suppkey % 5 = 4""")
def crosswalk_csv(spark, folder):
    landed = table(spark, folder, "supplier").select(
        F.col("s_name").alias("teamID"),
        (F.col("s_suppkey") % 5 + 2020).alias("yearID"),
        F.when(F.col("s_nationkey") % 2 == 0, "AL").otherwise("NL").alias("lgID"),
    )
    return files.read_crosswalk(spark, _land_csv(landed, "crosswalk"), 2024)


@query("""
select strftime(o_orderdate, '%Y%m%d') as date, o_orderkey::varchar as game_num, o_custkey % 30 as visiting_team,
       o_orderkey % 12 as visiting_score, null::varchar as "visiting_2_id.1", null::varchar as acquisition_info, 161 as n_columns
from (select o_orderdate, o_orderkey, (o_custkey % 30)::varchar as x, o_custkey from orders)""".replace(
    "o_custkey % 30 as visiting_team", "(o_custkey % 30)::varchar as visiting_team"
))
def game_log_files(spark, folder):
    """Short lines: only the first ten of 161 columns are there."""
    cell = lambda c: c.cast("string")
    orders = table(spark, folder, "orders")
    blank = [F.lit(None).cast("string").alias(f"b{i}") for i in range(6)]
    landed = orders.select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("a"),
        cell(F.col("o_orderkey")).alias("b"),
        blank[0],
        cell(F.col("o_custkey") % 30).alias("c"),
        *blank[1:],
        cell(F.col("o_orderkey") % 12).alias("d"),
    )
    logs = files.read_game_logs(spark, _land_csv(landed, "logs", header=False), ["visiting_score"])
    kept = ("date", "game_num", "visiting_team", "visiting_score", "visiting_2_id.1", "acquisition_info")
    return logs.select(*[ref(c) for c in kept], F.lit(len(logs.columns)).alias("n_columns"))


@query("""
select o_orderkey::varchar as date, o_orderstatus as game_num, o_orderpriority as date_of_makeup, 12 as n_columns from orders""")
def schedule_files(spark, folder):
    fill = [F.lit("x").alias(f"f{i}") for i in range(9)]
    landed = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string"), "o_orderstatus", *fill, "o_orderpriority")
    read = files.read_schedules(spark, _land_csv(landed, "schedules", header=False))
    return read.select("date", "game_num", "date_of_makeup", F.lit(len(read.columns)).alias("n_columns"))


@query("""
select 'p' || c_custkey as player_id, c_name as last_name, case when c_custkey % 2 = 0 then 'R' end as bats, c_nationkey::varchar as team,
       null::varchar as position, 7 as n_columns from customer""")
def positional_files(spark, folder):
    """Roster lines without a header; the last column is missing from all of them."""
    landed = table(spark, folder, "customer").select(
        F.concat(F.lit("p"), F.col("c_custkey").cast("string")), "c_name", F.lit("x").alias("f"),
        F.when(F.col("c_custkey") % 2 == 0, "R").alias("b"), F.lit("L").alias("t"), F.col("c_nationkey").cast("string"),
    )
    read = files.read_positional(spark, _land_csv(landed, "rosters", header=False), schemas.ROSTER_FILE, cut=True)
    return read.select("player_id", "last_name", "bats", "team", "position", F.lit(len(read.columns)).alias("n_columns"))


def _board(spark, folder, name):
    root = scratch_path(spark, "boards")
    landed = table(spark, folder, "supplier").select(
        F.concat_ws(", ", "s_name", F.lit("Jr")).alias("name"), F.col("s_suppkey").alias("player_id"), (F.col("s_nationkey") + 2000).alias("year")
    )
    landed.write.option("header", True).option("escape", '"').partitionBy("year").csv(f"{root}/{name}")
    return files.read_leaderboard(spark, root, name).select("name", "player_id", "year", "board")


_BOARD = "select s_name || ', Jr' as name, s_suppkey as player_id, (s_nationkey + 2000)::bigint as year, '{}' as board from supplier"


@query(_BOARD.format("run_value"))
def board_run_value(spark, folder):
    return _board(spark, folder, "run_value")


@query(_BOARD.format("catch_probability"))
def board_catch_probability(spark, folder):
    return _board(spark, folder, "catch_probability")


@query(_BOARD.format("poptime"))
def board_poptime(spark, folder):
    return _board(spark, folder, "poptime")


@query("""
select o_orderkey::varchar as date, 'beyond' as first_beyond from orders where o_orderkey % 3 = 0""")
def long_rows(spark, folder):
    """Schedule lines with more cells than a schedule has: the reader refuses them, this names them."""
    fill = [F.lit("x").alias(f"f{i}") for i in range(10)]
    beyond = F.when(F.col("o_orderkey") % 3 == 0, F.lit("beyond"))
    landed = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string"), "o_orderstatus", *fill, beyond.alias("beyond"))
    found = files.long_rows(spark, _land_csv(landed, "schedules", header=False), schemas.SCHEDULE_FILE)
    return found.select("date", F.col(files.BEYOND).alias("first_beyond"))


@query("""
select l_orderkey as game_pk, l_linenumber::bigint as inning, 'a, "b"' || chr(10) || l_returnflag as des from lineitem""")
def pitch_csv_quoted(spark, folder):
    """Cells with commas, quotes and line breaks inside quotes."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("game_pk"), F.col("l_linenumber").alias("inning"), F.concat(F.lit('a, "b"\n'), "l_returnflag").alias("des")
    )
    return files.read_pitch_csv(spark, _land_csv(lines, "pitch-quoted"))


@query("""
select l_orderkey as game_pk, l_linenumber::bigint as inning, case when l_linenumber < 4 then l_returnflag end as pitch_type,
       case when l_linenumber >= 4 then l_linestatus end as mode from lineitem""")
def pitch_csv_mixed(spark, folder):
    """Landed files of two headers in one folder."""
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("game_pk"), F.col("l_linenumber").alias("inning"), "l_returnflag", "l_linestatus")
    path = scratch_path(spark, "mixed")
    for some, last, name in (("inning < 4", "l_returnflag", "pitch_type"), ("inning >= 4", "l_linestatus", "mode")):
        part = lines.where(some).select("game_pk", "inning", F.col(last).alias(name))
        part.write.mode("append").option("header", True).csv(path)
    return files.read_mixed_csv(spark, path)


@query("""
select n_nationkey::varchar as park_id, n_name as name, n_regionkey::varchar as nickname from nation""")
def park_code_file(spark, folder):
    return files.read_park_codes(spark, _land_csv(table(spark, folder, "nation"), "parks"))


@query("""
select c_custkey as "playerID", case when c_custkey % 2 = 0 then c_name || ', "Jr"' || chr(10) || 'of ' || c_nationkey else c_name end as name,
       c_acctbal as "H" from customer""")
def archive_table(spark, folder):
    landed, compiled = scratch_path(spark, "landed"), scratch_path(spark, "compiled")
    types = {"playerID": "bigint", "name": "string", "H": "double"}
    quoted = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit(', "Jr"\nof '), F.col("c_nationkey").cast("string"))).otherwise(F.col("c_name"))
    people = table(spark, folder, "customer").select(F.col("c_custkey").alias("playerID"), quoted.alias("name"), F.col("c_acctbal").alias("H"))
    people.write.option("header", True).option("escape", '"').csv(f"{landed}/core/Batting.csv")
    archive.compile_table(spark, landed, compiled, "batting", schemas.struct(types))
    return archive.read_table(spark, compiled, "batting")


@query("""
select c_name as player_name, c_custkey as player_id, c_acctbal::varchar as stat_value, 2015 + c_nationkey as year, 'sprint_speed' as board from customer""".replace(
    "c_acctbal::varchar as stat_value", "'v' || c_custkey as stat_value"
).replace("2015 + c_nationkey as year", "(2015 + c_nationkey)::bigint as year"))
def leaderboard_ingest(spark, folder):
    root = scratch_path(spark, "boards")
    landed = table(spark, folder, "customer").select(
        F.col("c_name").alias("player_name"),
        F.col("c_custkey").alias("player_id"),
        F.concat(F.lit("v"), F.col("c_custkey").cast("string")).alias("stat_value"),
        (F.col("c_nationkey") + 2015).alias("year"),
    )
    landed.write.option("header", True).partitionBy("year").csv(f"{root}/sprint_speed")
    return files.read_leaderboard(spark, root, "sprint_speed")


@query("""
select 'p' || user_id % 3 as provider, event_type as url, event_id::varchar as body from events where user_id % 3 = 1""")
def landing_scan(spark, folder):
    path = scratch_path(spark, "landing")
    table(spark, folder, "events").select(
        F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("provider"),
        F.col("event_type").alias("url"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("params"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        F.col("event_id").cast("string").alias("body"),
    ).write.parquet(path)
    return payloads.read_landing(spark, path, "p1").select("provider", "url", "body")


@query("select o_custkey, 'EV' || o_orderkey as name from orders")
def season_listing(spark, folder):
    entries = F.array(F.struct(F.concat(F.lit("EV"), F.col("o_orderkey").cast("string")).alias("name")))
    landed = table(spark, folder, "orders").select("o_custkey", F.to_json(entries).alias("body"))
    return files.listing(landed).select("o_custkey", "name")
