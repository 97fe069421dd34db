"""The plans must be the ones that hold at scale."""

from __future__ import annotations

import inspect
import io
from contextlib import redirect_stdout
from pathlib import Path

from pyspark.sql import functions as F

import dugout
from dugout.functions import clean
from dugout.operators import boards, filters, joins, ranks
from dugout.operators.names import once
from dugout.plans import feeds, tables
from dugout.plans.catalog import QUERIES
from dugout.plans.catalog.base import table
from dugout.sources import pitches
from dugout.streaming import jobs

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_season_and_date_filters_reach_the_scan(spark, tmp_path):
    root = str(tmp_path / "ds")
    days = spark.createDataFrame([("2023-05-01", 1), ("2024-05-01", 2)], "game_date string, batter bigint")
    pitches.write_seasons(days, root, [2023, 2024])
    scan = pitches.scan_seasons(spark, root)
    text = plan(pitches.pitches_between(scan, "2024-04-01", "2024-06-01", order=("game_date",)).select("batter", "game_date"))
    assert "year" in text.split("PartitionFilters")[1].splitlines()[0]
    assert "GreaterThanOrEqual(game_date" in text and "ReadSchema: struct<game_date:string,batter:bigint>" in text
    files = pitches.scan_seasons(spark, root, 2024).inputFiles()
    assert len(files) >= 1


def test_top_k_and_rank_prune_early(spark):
    lines = table(spark, FOLDER, "lineitem")
    assert "TakeOrderedAndProject" in plan(boards.fastest(lines, 5, "l_suppkey", "l_returnflag", "l_extendedprice", ("A",)))
    assert "TakeOrderedAndProject" in plan(filters.clip_search(lines, newest=("l_shipdate",), limit=9))
    for df in (ranks.leaders(lines, ["l_returnflag"], [F.desc("l_quantity")], 3), ranks.latest(lines, ["l_orderkey"], [F.desc("l_shipdate")])):
        text = plan(df)
        assert text.index("WindowGroupLimit") < text.index("Exchange") or text.count("WindowGroupLimit") >= 2


def test_small_dimension_is_broadcast_by_size_only(spark):
    suppliers, nations = table(spark, FOLDER, "supplier"), table(spark, FOLDER, "nation")
    joined = joins.attach(suppliers, nations, {"s_nationkey": "n_nationkey"})
    assert "BroadcastHashJoin" in plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(joins.attach(suppliers, nations, {"s_nationkey": "n_nationkey"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_years_of_a_season_write_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "landed")
    spark.range(4).selectExpr("date_add(date'2023-12-30', cast(id as int)) as game_date", "id as batter").write.parquet(path)
    text = plan(pitches.season_rows(spark.read.parquet(path), [2023]))
    assert "GreaterThanOrEqual(game_date,2023-01-01)" in text and "LessThan(game_date,2024-01-01)" in text


def scans(df) -> int:
    """Reads of a table in the plan that runs."""
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_shares_read_the_table_once(spark):
    events = table(spark, FOLDER, "events")
    assert scans(boards.pitch_mix(events, "event_type", "value")) == 1
    renamed = events.selectExpr("user_id as pitcher", "event_type as pitch_type", "value as release_speed", "value as release_spin_rate", "value as estimated_woba_using_speedangle")
    assert scans(boards.arsenal_stats(renamed, minimum=2)) == 1
    assert scans(boards.arsenal_wide(renamed, "n_", minimum=2)) == 1


def test_percent_ranks_never_sort_a_whole_group(spark):
    text = plan(ranks.percent_ranks(table(spark, FOLDER, "customer"), ["c_mktsegment"], "c_acctbal"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_percentile_plan_does_not_grow_with_the_metrics(spark):
    lines = table(spark, FOLDER, "lineitem")
    made = lines.select("l_returnflag", "l_orderkey", *[(F.col("l_quantity") + i).alias(f"m{i}") for i in range(10)])
    sizes = [scans(ranks.percent_ranks_of(made, ["l_returnflag"], {f"m{i}": f"r{i}" for i in range(n)})) for n in (1, 3, 10)]
    assert len(set(sizes)) == 1


def test_rows_of_frequent_values_are_ranked_where_they_are(spark):
    lines = spark.range(2000).selectExpr("id % 3 as g", *[f"id % {5 + i} as m{i}" for i in range(3)])
    steps = simple_plan(ranks.percent_ranks_of(lines, ["g"], {f"m{i}": f"r{i}" for i in range(3)}))
    beside = steps[steps.index("Union") : steps.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in beside and "Range" in beside and "hashpartitioning" not in beside


def test_library_avoids_what_does_not_scale():
    root = Path(inspect.getfile(dugout)).parent
    sources = {p: p.read_text() for p in root.rglob("*.py") if p.relative_to(root).parts[0] != "llm"}
    for path, text in sources.items():
        for word in ("crossJoin", "localCheckpoint", "toPandas", "F.udf(", "collect_list", "broadcast("):
            assert word not in text, (path, word)


def simple_plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_costly_columns_stay_out_of_generated_methods(spark):
    texts = spark.range(3).select(F.col("id").cast("string").alias("v"))
    made = once(texts, **{f"c{i}": F.col("v").try_cast("bigint") for i in range(30)})
    assert [line for line in simple_plan(made).splitlines() if "Generate" in line and "*(" not in line]


def test_row_faults_are_found_outside_the_filter(spark):
    landed = spark.createDataFrame([('{"allPlays":[{"about":{"inning":1}}]}', {"gamePk": "1"})], "body string, params map<string,string>")
    conditions = [line for line in simple_plan(feeds.play_by_play(landed)).splitlines() if "Filter" in line and "Payload row rejected" in line]
    assert conditions and all("inning is unreadable" not in line for line in conditions)


def test_rows_are_typed_and_judged_at_once(spark):
    landed = spark.createDataFrame([("{}", {"gamePk": "1"})], "body string, params map<string,string>")
    steps = [line for line in simple_plan(feeds.live_feed(landed)).splitlines() if "Generate" in line]
    assert len(steps) == 4  # the payload, its plays, their events, the typed row with its fault


def test_events_that_are_no_pitch_are_told_before_they_are_read(spark, tmp_path):
    steps = simple_plan(jobs.live_pitches(jobs.landed_stream(spark, str(tmp_path)))).splitlines()
    told = next(i for i, line in enumerate(steps) if "Filter" in line and "isPitch" in line and "_typed" not in line and "StructField" not in line)
    assert told > next(i for i, line in enumerate(steps) if "Generate" in line and "_typed" in line)


def test_gamefeed_objects_are_parsed_with_their_payload(spark):
    landed = spark.createDataFrame([("{}", {"gamePk": "1"})], "body string, params map<string,string>")
    steps = [line for line in simple_plan(feeds.exit_velocity(landed)).splitlines() if "Generate" in line]
    assert len(steps) == 3  # the payload, its objects, one row each


def test_words_never_reach_a_cast(spark):
    texts = spark.createDataFrame([("true",), ("12.0",), (" 7 ",), ("-.5",), ("NaN",), ("Infinity",), (None,)], "v string")
    read = texts.select(clean.lenient_double(F.col("v")).alias("d"), clean.lenient_int(F.col("v")).alias("i"))
    assert "RLIKE" in simple_plan(read).upper()
    assert [tuple(r) for r in read.collect()] == [(None, None), (12.0, 12), (7.0, 7), (-0.5, 0), (None, None), (float("inf"), None), (None, None)]


def test_pages_of_a_small_table_are_read_by_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    for name in ("html_stat_table", "html_game_log", "html_splits", "html_all_tables"):
        assert QUERIES[name](spark, FOLDER).rdd.getNumPartitions() == cores, name


def test_sorted_prospects_parse_their_pages_once(spark):
    body = "<table><tr><th>Rk</th><th>Player</th></tr><tr><td>1</td><td>A</td></tr></table>"
    pages = spark.createDataFrame([(1, body)], "page int, html string")
    steps = simple_plan(tables.prospects(pages, ["page"], ["Rk", "Player"])).splitlines()
    at = [next(i for i, line in enumerate(steps) if word in line) for word in ("rangepartitioning", "REBALANCE", "MapInArrow")]
    assert at == sorted(at)


def test_numbers_of_polls_are_read_as_numbers(spark, tmp_path):
    steps = [line for line in simple_plan(jobs.live_pitches(jobs.landed_stream(spark, str(tmp_path)))).splitlines() if "Generate" in line]
    assert len(steps) == 2  # all rows of a payload, and what had to be cast
    assert "StructField(index,LongType" in steps[1] and "StructField(startSpeed,DoubleType" in steps[1]
