from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter, PayloadRejected, SchemaMismatch
from dugout.functions import statcols
from dugout.operators import align, boards, filters, joins, lookup, ranks, seasons, typed
from dugout.operators.names import once, types_of
from dugout.sources import schemas


def test_declared_tables_have_their_size():
    assert len(schemas.PITCH) == 89 and len(schemas.GAME_LOG_FILE) == 161
    assert len(set(schemas.GAME_LOG_FILE)) == 161 and "visiting_2_id.1" in schemas.GAME_LOG_FILE
    assert len(schemas.ARCHIVE_TABLES) == 28 and len(schemas.LEADERBOARDS) == 21
    assert len(schemas.WAR_BATTING) == 17 and len(schemas.WAR_PITCHING) == 19


def test_strict_table(spark):
    df = spark.createDataFrame([("1", "x", "y")], "id string, name string, more string")
    cast = typed.strict_table(df, ["id"], {"id": "bigint"})
    assert types_of(cast) == {"id": "bigint", "name": "string", "more": "string"}
    with pytest.raises(SchemaMismatch, match="season"):
        typed.strict_table(df, ["season"], {})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed.strict_table(df, ["id"], {"name": "bigint"}).collect()


def test_canonical_table(spark):
    df = spark.createDataFrame([("5", "95.1", "z")], "zone string, release_speed string, extra string")
    row = typed.canonical_table(df, schemas.PITCH).first()
    assert (row.zone, row.release_speed, row.extra, row.pitch_type) == (5, 95.1, "z", None)
    assert len(row) == 90


def test_stat_types_by_name():
    assert typed.stat_type("HR") == "bigint" and typed.stat_type("Basic_OPS") == "double"
    assert typed.stat_type("Basic_H") == "bigint" and typed.stat_type("Opp_H") is None
    assert typed.stat_type("mlbID") == "string" and typed.stat_type("Tm") is None


def test_coerce_stats_fails_fast(spark):
    good = spark.createDataFrame([("1,234", "---", ".300")], "AB string, HR string, BA string")
    assert tuple(typed.coerce_stats(good).first()) == (1234, None, 0.3)
    bad = spark.createDataFrame([("not_a_number",)], "Basic_AB string")
    with pytest.raises(Exception, match="failed strict cast: Column 'Basic_AB'"):
        typed.coerce_stats(bad).collect()
    assert [tuple(r) for r in typed.cast_audit(bad, typed.stat_rules(bad)).collect()] == [("Basic_AB", 1, 1)]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("1", "2")], "`W-L%` string, `visiting_2_id.1` string")
    assert tuple(typed.lenient_casts(df, {"W-L%": "double", "visiting_2_id.1": "bigint"}).first()) == (1.0, 2)
    assert typed.drop_all_null(df.withColumn("x.y", F.lit(None).cast("string"))).columns == df.columns


def test_union_of_conflicting_types(spark):
    a = spark.createDataFrame([(70.5, 1, 1)], "bat_speed double, game_pk bigint, n int")
    b = spark.createDataFrame([("", "789", 2), ("null", "x", 3)], "bat_speed string, game_pk string, n bigint")
    whole = align.diagonal_union(a, b)
    assert types_of(whole) == {"bat_speed": "double", "game_pk": "bigint", "n": "bigint"}
    assert sorted(map(tuple, whole.collect()), key=lambda r: r[2]) == [(70.5, 1, 1), (None, 789, 2), (None, None, 3)]
    with pytest.raises(SchemaMismatch):
        align.vertical_union(a, b)


_KINDS = st.sets(st.sampled_from(["string", "double", "float", "int", "bigint", "boolean"]), min_size=2)


@given(_KINDS)
def test_policies(kinds):
    result = align.pitch_policy("c", kinds)
    numbers = kinds - {"string", "boolean"}
    if "string" in kinds and numbers or numbers & {"double", "float"}:
        assert result == "double"
    elif numbers:
        assert result == "bigint"
    else:
        assert result == "string"
    assert align.prospect_policy("c", kinds) == ("double" if "double" in kinds and "string" not in kinds else "string")


def test_filter_language(spark):
    df = spark.createDataFrame([("Judge", 58, "NYY"), ("Soto", 41, "NYY"), ("X", None, "LAA")], "Name string, HR int, Team string")
    found = filters.stat_filter(df, [("HR", ">", "20.0"), ("Team", "==", "NYY"), ("HR", "ne", 41)])
    assert [r.Name for r in found.collect()] == ["Judge"]
    with pytest.raises(InvalidParameter):
        filters.stat_filter(df, [("None", ">", 1)])
    with pytest.raises(InvalidParameter):
        filters.rule("HR", "~", 1)
    with pytest.raises(TypeError):
        filters.stat_filter(df, [("HR", ">")])


@given(st.lists(st.tuples(st.from_regex(r"[A-Za-z%+-]{1,8}", fullmatch=True), st.sampled_from(["gt", "gte", "lt", "lte", "eq", "ne"]), st.from_regex(r"[A-Za-z0-9.]{1,6}", fullmatch=True)), max_size=4))
def test_filter_text_round_trip(rules):
    wanted = [filters.rule(*rule) for rule in rules]
    assert filters.parse_filters(filters.format_filters(wanted)) == wanted


def test_clip_bounds_and_default(spark):
    df = spark.createDataFrame([("Home Run", 1), ("Single", 2)], "event_type string, date int")
    assert [r.date for r in filters.find_clips(df).collect()] == [1]
    assert [r.date for r in filters.find_clips(df, bounds={"date": (1, None)}).collect()] == [2, 1]
    with pytest.raises(InvalidParameter):
        filters.find_clips(df, bounds={"date": (3, 1)})


def test_argument_rules():
    with pytest.raises(InvalidParameter):
        filters.year_list((2020, 2018))
    assert len(filters.year_list()) == 1
    assert filters.year_list((2021, 2023)) == [2021, 2022, 2023] and filters.year_list(2020) == [2020]
    with pytest.raises(InvalidParameter):
        filters.year_list(2014)
    assert seasons.date_range("2024-05-02", "2024-05-01") == (date(2024, 5, 1), date(2024, 5, 2))
    assert seasons.date_range(None, date(2024, 2, 29)) == (date(2024, 2, 29), date(2024, 2, 29))
    assert seasons.date_range(None, None, date(2024, 5, 2)) == (date(2024, 5, 1), date(2024, 5, 2))
    assert seasons.current_season(date(2024, 3, 14)) == 2023 and seasons.current_season(date(2024, 3, 15)) == 2024
    for wrong in ("2023-02-29", "", "01/02/2024"):
        with pytest.raises(InvalidParameter):
            seasons.as_date(wrong)


def _chunks_by_hand(low, stop, step):
    """Day-by-day restatement: walk on, jump to the next season when outside one."""

    def edges(year):
        first, last = schemas.SEASONS.get(year, (f"{year}-03-15", f"{year}-11-15"))
        return date.fromisoformat(first), date.fromisoformat(last)

    found = []
    while low <= stop:
        first, last = edges(low.year)
        low = first if low < first else edges(low.year + 1)[0] if low > last else low
        if low <= stop:
            found.append((low, min(low + timedelta(step - 1), stop)))
        low += timedelta(step)
    return found


@settings(max_examples=12, deadline=None)
@given(st.dates(date(2004, 1, 1), date(2028, 1, 1)), st.integers(0, 1500), st.sampled_from([1, 3, 7, 30, 150, 400]))
def test_season_chunks(spark, low, days, step):
    stop = low + timedelta(days)
    df = spark.createDataFrame([(low, stop)], "a date, b date")
    got = [(r.chunk_start, r.chunk_end) for r in seasons.season_chunks(df, "a", "b", step).orderBy("chunk_start").collect()]
    assert got == _chunks_by_hand(low, stop, step)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 6))), min_size=1, max_size=40), st.sampled_from([2, 256]))
def test_percent_ranks_equal_the_window(spark, rows, buckets):
    from pyspark.sql import Window

    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "i int, g string, v int")
    window = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first())
    want = {r.i: r.p for r in df.withColumn("p", F.percent_rank().over(window)).collect()}
    got = {r.i: r.percent_rank for r in ranks.percent_ranks(df, ["g"], "v", buckets=buckets).collect()}
    assert got == want


def test_percent_ranks_of_frequent_and_rare_values_equal_the_window(spark):
    from pyspark.sql import Window

    rows = [(i, "ab"[i % 2], i % 3 or None, float(i % 7), i) for i in range(40)] * 2 + [(99, None, None, None, None)]
    df = spark.createDataFrame(rows, "i int, g string, u int, v double, w int")
    for by, metrics, frequent in ((["g"], "uvw", 2), ([], "uw", 1), (["g"], "uv", 0), (["g"], "uvw", 512), (["g"], "w", 1)):
        asked = [F.percent_rank().over(Window.partitionBy(*by).orderBy(F.col(m).asc_nulls_first())).alias(f"r{m}") for m in metrics]
        want = df.select("*", *asked).collect()
        got = ranks.percent_ranks_of(df, by, {m: f"r{m}" for m in metrics}, frequent=frequent).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)), (by, metrics, frequent)


def test_best_item_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(["a1", "b9", "c9", None],), ([None],), ([],)], "v array<string>")
    score = lambda c: F.substring(c, 2, 1).cast("int")
    assert [r[0] for r in df.select(ranks.best_item(F.col("v"), score)).collect()] == ["b9", None, None]


def test_regression_rules(spark):
    past = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("c", 2.0), ("c", 2.0)], "profile string, w double")
    now = spark.createDataFrame([("a", 9.0), ("b", 99.0), ("c", 2.5), ("d", 1.0)], "profile string, w double")
    got = {r.profile: r for r in boards.regression_check(past, now, metric="w").collect()}
    assert got["a"].is_regression and abs(got["a"].sigma - 7 / 2**0.5) < 1e-9
    assert not got["b"].is_regression and got["b"].sigma == 0.0 and got["b"].baseline_mean == 99.0
    assert got["c"].sigma == 0.5 and not got["d"].is_regression


def test_standings_ties(spark):
    games = spark.createDataFrame(
        [("E", "B", True), ("E", "A", True), ("E", "B", False), ("E", "A", False), ("E", "C", False)],
        "division string, team string, won boolean",
    )
    table = {r.team: (r.W, r.L, r.GB) for r in boards.standings(games).collect()}
    assert table == {"A": (1, 1, 0.0), "B": (1, 1, 0.0), "C": (0, 1, 0.5)}


def test_reverse_ids(spark):
    df = spark.createDataFrame([(545361, "trout001", -1), (-1, "x", 7)], "key_mlbam bigint, key_retro string, key_fangraphs bigint")
    assert joins.by_ids(df, ["545361"]).count() == 1
    assert joins.by_ids(df, ["trout001"], "retro").count() == 1
    with pytest.raises(InvalidParameter):
        joins.by_ids(df, ["invalid_id"])
    with pytest.raises(InvalidParameter):
        joins.by_ids(df, [1], "unknown")


def test_once_computes_before_filters(spark):
    df = once(spark.range(3), j=F.from_json(F.lit('{"a":1}'), "a int"))
    plan = df.where("j.a > 0 and j.a < 5")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 1


def test_other_boards(spark):
    rows = [("p1", "FF", 95.0, 2200.0, 10.0), ("p1", "CH", 85.0, 1800.0, 30.0), ("p2", "FF", 99.0, 2500.0, 0.0)]
    df = spark.createDataFrame(rows, "pitcher string, pitch_type string, release_speed double, release_spin_rate double, spin_axis double")
    wide = {r.pitcher: r for r in boards.arsenal_wide(df, "avg_spin").collect()}
    assert wide["p1"].FF == 2200.0 and wide["p2"].CH is None
    shares = {(r.pitcher, r.pitch_type): r.pitch_usage for r in boards.arsenal_stats(df, value="spin_axis").collect()}
    assert shares[("p1", "FF")] == 50.0 and shares[("p2", "FF")] == 100.0
    spin = boards.spin_comparison(df).collect()
    assert [(r.pitcher, r.axis_difference) for r in spin] == [("p1", -20.0)]
    with pytest.raises(InvalidParameter):
        boards.bat_tracking(df)


def test_filter_values_keep_every_digit(spark):
    df = spark.createDataFrame([(9007199254740992,), (9007199254740993,), (None,)], "id bigint")
    assert [r.id for r in filters.stat_filter(df, [("id", "=", "9007199254740993")]).collect()] == [9007199254740993]
    assert filters.stat_filter(df, [("id", ">", "9007199254740992.5")]).count() == 1
    with pytest.raises(InvalidParameter):
        filters.stat_filter(df, [("id", "=", "many")])


def test_all_positions_are_refused(spark):
    df = spark.createDataFrame([("7",)], "pos string")
    for position in ("ALL", "OF", "C"):
        with pytest.raises(InvalidParameter):
            filters.positioned(df, position)


def test_stat_scope_checks_its_codes():
    assert boards.stat_scope() == {"category": ["bat"]}
    assert boards.stat_scope("pit", "al", "may", "ss") == {"category": ["pit"], "league": ["al"], "month": [5], "position": ["ss"]}
    for wrong in ({"category": "x"}, {"league": "x"}, {"month": "x"}, {"position": "x"}):
        with pytest.raises(InvalidParameter):
            boards.stat_scope(**wrong)


def test_stat_columns_are_resolved_by_name_alias_group_and_all():
    bat = statcols.stat_columns("bat")
    assert bat.resolve(["home_runs", " hr ", "Slash_line", ""]) == ["HR", "HR", "AVG", "OBP", "SLG"]
    assert bat.resolve([]) == [] and bat.folded([]) == [] and bat.request_text("") == ""
    assert bat.request_text(["name", "HR", "season", "common", "war"]) == "c,11,58"
    assert bat.request_text("all").startswith("c,-1,3,4,5,6,7,8,9,10,11,") and ",2," not in bat.request_text("ALL")
    assert statcols.stat_columns("fld").request_text(["POSITION", "uzr"]) == "c,39"
    assert statcols.stat_columns("rel") is statcols.PITCHING
    assert statcols.PITCHING.request_text(["ERA", "FIP", "NEGATIVE_WPA"]) == "c,6,45,64"
    more = bat.extended(["XBH"], {"EXTRA_BASE_HITS": "XBH"}, {"POWER": ("hr", "extra_base_hits")})
    assert more.resolve("power") == ["HR", "XBH"] and more.request_text("XBH") == f"c,{len(bat.names)}"
    for wrong in (lambda: bat.resolve("ERA"), lambda: statcols.stat_columns("x")):
        with pytest.raises(InvalidParameter):
            wrong()


def test_stat_columns_project_a_table(spark):
    df = spark.createDataFrame([("a", "t", 2020, 5, 2, 9)], "Name string, Team string, Season int, h int, HR int, extra int")
    bat = statcols.BATTING
    assert bat.project(df, ["HITS", "name", "hits"]).columns == ["Name", "Team", "Season", "h"]
    assert bat.project(df, [], keep=["extra"]).columns == ["extra", "Name", "Team", "Season", "h", "HR"]
    with pytest.raises(InvalidParameter, match="no column AVG"):
        bat.project(df, "AVG")


def test_nothing_where_something_must_be_is_an_error(spark):
    spins = spark.createDataFrame([(2020, "other")], "year int, spin_type string")
    with pytest.raises(PayloadRejected, match="active spin"):
        boards.active_spin(spins)
    rows = spark.createDataFrame([(0,)], "table_index int")
    assert align.pick_table(rows, "batters").count() == 1
    with pytest.raises(PayloadRejected, match="pitchers"):
        align.pick_table(rows, "pitchers")
    with pytest.raises(InvalidParameter):
        align.pick_table(rows, "catchers")
    with pytest.raises(PayloadRejected, match="no rows"):
        lookup.normalize_register(spark.createDataFrame([], "key_mlbam string"))


def test_one_key_by_name(spark):
    teams = spark.createDataFrame([(1, "Red Sox"), (-1, "Ghosts"), (2, "Twins"), (3, "twins")], "id int, name string")
    assert joins.key_by_name(teams, "red-sox", "name", "id") == 1
    for wrong in ("Ghosts", "Nobody", "Twins"):
        with pytest.raises(InvalidParameter):
            joins.key_by_name(teams, wrong, "name", "id")


def test_years_from_a_start_and_an_end():
    assert filters.year_list(start=2018, end=2020) == [2018, 2019, 2020]
    for wrong in ({"start": 2018}, {"end": 2018}, {"start": 2020, "end": 2018}, {"start": "2018", "end": 2020}):
        with pytest.raises(InvalidParameter):
            filters.year_list(**wrong)


def test_sort_by_several_columns(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c"), (2, None)], "x int, y string")
    assert [tuple(r) for r in ranks.sorted_by(df, ["x", "y"], [False, True]).collect()] == [(None, "c"), (1, "b"), (1, "a"), (2, None)]
    assert [r.x for r in ranks.sorted_by(df, ["x"], True, nulls_last=True).collect()] == [2, 1, 1, None]
    with pytest.raises(InvalidParameter):
        ranks.sorted_by(df, ["x", "y"], [True])
