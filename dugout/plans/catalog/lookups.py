"""Player lookup on customers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugout.functions import clean
from dugout.operators import lookup
from dugout.plans.catalog.base import query, table

_REGISTER = """
with r as (select 'Náme' || c_custkey % 40 as name_last, 'Fïrst' || c_custkey % 7 as name_first,
  case when c_custkey % 5 = 0 then null else c_custkey end as key_mlbam,
  case when c_custkey % 3 = 0 then null else 'r' || c_custkey end as key_retro,
  case when c_custkey % 4 = 0 then null else c_nationkey end as key_fangraphs from customer)"""


def _people(spark, folder):
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        F.concat(F.lit("Náme"), (key % 40).cast("string")).alias("name_last"),
        F.concat(F.lit("Fïrst"), (key % 7).cast("string")).alias("name_first"),
        F.when(key % 5 != 0, key).alias("key_mlbam"),
        F.when(key % 3 != 0, F.concat(F.lit("r"), key.cast("string"))).alias("key_retro"),
        F.when(key % 4 != 0, F.col("c_nationkey")).alias("key_fangraphs"),
    )


@query(_REGISTER + """
select name_last, name_first, coalesce(key_mlbam, -1) as key_mlbam, key_retro, null::varchar as key_bbref,
       coalesce(key_fangraphs, -1)::bigint as key_fangraphs, null::double as mlb_played_first, null::double as mlb_played_last
from r where key_retro is not null or key_fangraphs is not null""")
def register_normalize(spark, folder):
    return lookup.normalize_register(_people(spark, folder))


@query(_REGISTER + """
select lower(name_last) as name_last, lower(name_first) as name_first, strip_accents(lower(name_last)) as name_last_plain,
       strip_accents(lower(name_first)) as name_first_plain, key_mlbam from r""")
def lookup_table(spark, folder):
    return lookup.lookup_table(_people(spark, folder).select("name_last", "name_first", "key_mlbam"))


@query(_REGISTER + """
select lower(name_last) as name_last, lower(name_first) as name_first, key_mlbam from r
where lower(name_last) = 'náme12' and lower(name_first) = 'fïrst3'""")
def exact_lookup(spark, folder):
    people = lookup.lookup_table(_people(spark, folder).select("name_last", "name_first", "key_mlbam"))
    return lookup.find_player(people, "NÁME12", "Fïrst3")


@query(_REGISTER + """
select lower(name_last) as name_last, lower(name_first) as name_first, key_mlbam from r
where strip_accents(lower(name_last)) = 'name12'""")
def accent_lookup(spark, folder):
    people = lookup.lookup_table(_people(spark, folder).select("name_last", "name_first", "key_mlbam"))
    return lookup.find_player(people, "Namè12", ignore_accents=True)


def _names(spark, folder):
    words = F.split("p_name", " ")
    return table(spark, folder, "part").select(
        "p_partkey", words[1].alias("name_last"), words[0].alias("name_first")
    )


@query()
def fuzzy_names(spark, folder):
    return lookup.suggest_players(_names(spark, folder), "wigdet", "smal")


@query()
def fuzzy_batch(spark, folder):
    return lookup.suggest_many(_names(spark, folder), [("wigdet", "smal"), ("rinng", "hot"), ("plaate", "redd")])


@query("select c_custkey, c_name from customer where length(c_name) between 15 and 21")
def length_window(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", "c_name").where(clean.length_near(F.col("c_name"), 18, 3))
