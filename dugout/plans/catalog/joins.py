"""Joins on dimensions, keys and pointers."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugout.operators import joins
from dugout.plans.catalog.base import query, table


@query("""
select s_suppkey, s_name, n_nationkey, n_name, n_regionkey, r_regionkey, r_name
from supplier left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""")
def dim_join(spark, folder):
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    placed = joins.attach(suppliers, table(spark, folder, "nation"), {"s_nationkey": "n_nationkey"})
    return joins.attach(placed, table(spark, folder, "region"), {"n_regionkey": "r_regionkey"}).drop("s_nationkey")


@query("""
with b as (select l_suppkey as "batting.team", year(l_shipdate)::int as "batting.season", count(*) as "batting.G" from lineitem group by all),
c as (select s_suppkey, 1998::int as year_id from supplier)
select s_suppkey, year_id, "batting.team", "batting.season", "batting.G" from c
join b on s_suppkey = "batting.team" and year_id = "batting.season\"""")
def team_join(spark, folder):
    batting = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("team"), F.year("l_shipdate").alias("season"))
        .agg(F.count(F.lit(1)).alias("G"))
    )
    crosswalk = table(spark, folder, "supplier").select("s_suppkey", F.lit(1998).alias("year_id"))
    return joins.prefixed_join(crosswalk, batting, "batting.", {"s_suppkey": "team", "year_id": "season"})


@query("""
with r as (select c_custkey as key_mlbam, 'f' || c_custkey as key_fangraphs from customer where c_custkey % 10 != 3
           union all select -1, 'f' || c_custkey from customer where c_custkey % 10 = 3)
select o_orderkey, batter, key_mlbam, key_fangraphs
from (select o_orderkey, case when o_orderkey % 50 = 0 then -1 else o_custkey end as batter from orders) o
left join (select * from r where key_mlbam != -1) r on batter = key_mlbam""")
def id_map(spark, folder):
    key = F.col("c_custkey")
    register = table(spark, folder, "customer").select(
        F.when(key % 10 == 3, -1).otherwise(key).alias("key_mlbam"),
        F.concat(F.lit("f"), key.cast("string")).alias("key_fangraphs"),
    )
    batters = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 50 == 0, -1).otherwise(F.col("o_custkey")).alias("batter")
    )
    return joins.with_player_keys(batters, register, "batter")


@query("select c_custkey, n_nationkey, n_name from customer join nation on c_nationkey = n_nationkey")
def name_key_join(spark, folder):
    typed = table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("na-TION_ "), F.col("c_nationkey").cast("string")).alias("team")
    )
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return joins.by_name_key(typed, nations, "team", "n_name").drop("team")


_PLAYERS = """
with p as (select c_custkey as key_mlbam, 'last' || c_custkey % 97 as name_last, 'first' || c_custkey % 31 as name_first,
                  'r' || c_custkey as key_retro from customer)"""


def _players(spark, folder):
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("key_mlbam"),
        F.concat(F.lit("last"), (key % 97).cast("string")).alias("name_last"),
        F.concat(F.lit("first"), (key % 31).cast("string")).alias("name_first"),
        F.concat(F.lit("r"), key.cast("string")).alias("key_retro"),
    )


@query(_PLAYERS + """ select * from p where (name_last, name_first) in (('last5', 'first5'), ('last12', 'first9'), ('last40', 'first1'))""")
def batch_lookup(spark, folder):
    wanted = [("Last5", "First5"), ("LAST12", "first9"), ("last40", "first1"), ("last40", "first1")]
    return joins.by_names(_players(spark, folder), wanted)


@query(_PLAYERS + " select * from p where key_mlbam in (3, 77, 901)")
def reverse_lookup(spark, folder):
    return joins.by_ids(_players(spark, folder), ["3", 77, "901"], "mlbam")


@query(_PLAYERS + " select * from p where key_retro in ('r8', 'r15')")
def reverse_lookup_text(spark, folder):
    return joins.by_ids(_players(spark, folder), ["r8", "r15"], "retro")


@query("select * from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def semi_keys(spark, folder):
    customers = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    wanted = customers.union(customers).select("c_custkey")
    return joins.matching(table(spark, folder, "orders"), wanted, {"o_custkey": "c_custkey"})


@query("""
select c_custkey, n_name as team, r_name as level from customer
left join nation on n_nationkey = c_nationkey and c_custkey % 9 != 0 left join region on r_regionkey = n_regionkey""")
def pointer_resolve(spark, folder):
    """Every nation's customers form a payload that holds its own team and level."""
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    item = lambda **fields: F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    teams = nations.select(
        F.col("n_nationkey").alias("payload_id"),
        F.concat(F.lit("Team:"), F.col("n_nationkey").cast("string")).alias("ref"),
        item(name=F.col("n_name"), sport=F.concat(F.lit("Sport:"), F.col("n_regionkey").cast("string"))).alias("value"),
    )
    levels = nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_nationkey").alias("payload_id"),
        F.concat(F.lit("Sport:"), F.col("r_regionkey").cast("string")).alias("ref"),
        item(abbreviation=F.col("r_name")).alias("value"),
    )
    entities = teams.unionByName(levels)
    items = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("payload_id"))
    pointer = F.when(F.col("c_custkey") % 9 != 0, F.concat(F.lit("Team:"), F.col("payload_id").cast("string")))
    value = F.col("value")
    placed = joins.follow(
        items,
        entities,
        pointer,
        {
            "team": F.get_json_object(value, "$.name"),
            "sport_ref": F.get_json_object(value, "$.sport"),
        },
    )
    fields = {"level": F.get_json_object(value, "$.abbreviation")}
    return joins.follow(placed, entities, F.col("sport_ref"), fields).select("c_custkey", "team", "level")
