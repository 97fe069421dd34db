"""Unions of slices whose columns and types differ, and source fallback."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugout.operators import align
from dugout.operators.typed import add_missing, drop_named_like, known_columns, strict_table
from dugout.plans.catalog.base import query, table


@query("""
select s_suppkey as id, s_name as name, s_acctbal as balance, null::varchar as segment from supplier
union all select c_custkey, null, c_acctbal, c_mktsegment from customer""")
def diagonal_union(spark, folder):
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey as id", "s_name as name", "s_acctbal as balance")
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey as id", "c_acctbal as balance", "c_mktsegment as segment"
    )
    return align.diagonal_union(suppliers, customers)


@query("""
select s_suppkey as id, s_nationkey::bigint as game_pk, s_acctbal as bat_speed, s_suppkey::double as mixed,
       s_nationkey::bigint as width, 'true' as word from supplier
union all select c_custkey, try_cast(c_custkey::varchar as bigint), null, try_cast(c_mktsegment as double),
       c_custkey, c_name from customer""")
def conflict_union(spark, folder):
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_suppkey as id",
        "s_nationkey as game_pk",
        "s_acctbal as bat_speed",
        "s_suppkey as mixed",
        "s_nationkey as width",
        "true as word",
    )
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey as id",
        "cast(c_custkey as string) as game_pk",
        "'' as bat_speed",
        "c_mktsegment as mixed",
        "c_custkey as width",
        "c_name as word",
    )
    return align.diagonal_union(suppliers, customers)


@query("""
select s_suppkey as id, s_name as rank_text, s_nationkey::double as grade, s_nationkey::varchar as level from supplier
union all select c_custkey, c_custkey::varchar, c_custkey::double, c_custkey::varchar from customer""")
def prospect_union(spark, folder):
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_suppkey as id", "s_name as rank_text", "cast(s_nationkey as double) as grade", "s_nationkey as level"
    )
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey as id", "c_custkey as rank_text", "c_custkey as grade", "c_custkey as level"
    )
    return align.diagonal_union(suppliers, customers, policy=align.prospect_policy)


@query("select s_suppkey as id, s_name as name from supplier union all select c_custkey, c_name from customer")
def vertical_union(spark, folder):
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey as id", "s_name as name")
    customers = table(spark, folder, "customer").selectExpr("c_custkey as id", "c_name as name")
    return align.vertical_union(suppliers, customers)


@query("""
with p as (select event_id, user_id, event_type, case event_type when 'purchase' then 1 when 'click' then 2 end as pr
           from events where event_type in ('purchase', 'click') and not (user_id % 3 = 0 and event_type = 'purchase'))
select event_id, user_id, event_type from p where pr = (select min(pr) from p q where q.user_id = p.user_id)""")
def source_fallback(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    absent = (F.col("user_id") % 3 == 0) & (F.col("event_type") == "purchase")
    variants = events.where(F.col("event_type").isin("purchase", "click") & ~absent)
    ordered = variants.withColumn("priority", F.when(F.col("event_type") == "purchase", 1).otherwise(2))
    return align.first_source(ordered, ["user_id"], "priority").drop("priority")


@query("select l_orderkey, l_linenumber - 1 as table_index from lineitem where l_linenumber = 2")
def table_pick(spark, folder):
    rows = table(spark, folder, "lineitem").selectExpr("l_orderkey", "l_linenumber - 1 as table_index")
    return align.pick_table(rows, "pitchers")


@query("""select c_custkey as id, c_name as name, c_acctbal::varchar::double as balance, c_mktsegment as extra, null::bigint as season
from customer""")
def strict_types(spark, folder):
    landed = table(spark, folder, "customer").selectExpr(
        "cast(c_custkey as string) as id", "c_name as name", "cast(c_acctbal as string) as balance", "c_mktsegment as extra"
    )
    types = {"id": "bigint", "name": "string", "balance": "double", "season": "bigint"}
    return add_missing(strict_table(landed, ["id", "name"], types), types)


@query("select c_custkey as id, c_acctbal as balance from customer")
def known_subset(spark, folder):
    landed = table(spark, folder, "customer").selectExpr(
        "c_acctbal as balance", "c_custkey as id", "c_name as Tm_name", "c_mktsegment as Unnamed_1"
    )
    return known_columns(drop_named_like(landed, ("Tm", "Unnamed")), {"id": "bigint", "season": "int", "balance": "double"})
