"""Payload plans on small literals."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter
from dugout.operators.names import types_of
from dugout.plans import clips, feeds, flatten
from dugout.plans.flatten import Plan, Step


def landed(spark, *bodies, **params):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    rows = [(t, {k: str(v) for k, v in params.items()}) for t in texts]
    return spark.createDataFrame(rows, "body string, params map<string,string>")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_schedule(spark):
    game = {
        "gamePk": 1, "season": "2024", "gameDate": "2024-04-01T00:00:00Z", "doubleHeader": False,
        "teams": {"away": {"team": {"id": 110}, "score": 3}, "home": "none"}, "decisions": {"winner": {"id": 9}},
    }
    table = feeds.schedule(landed(spark, {"dates": [{"games": [game, 5, {}]}, {"games": "x"}]}, {"dates": []}, "not json"))
    found = rows(table)
    assert len(table.columns) == 41 and len(found) == 2
    one = next(r for r in found if r["gamePk"] == 1)
    assert (one["doubleHeader"], one["awayTeamId"], one["awayScore"], one["homeTeamId"], one["winnerPitcherId"]) == (
        "false", 110, 3, None, 9,
    )


def test_boxscore(spark):
    player = {
        "person": {"id": 5, "fullName": "A"}, "battingOrder": "100",
        "stats": {"batting": {"hits": 2, "more": {"x": 1}}, "pitching": {"inningsPitched": "5.2"}, "fielding": {}},
    }
    home = {"team": {"id": 2}, "players": {"ID6": {"person": {"id": 6}, "battingOrder": ""}, "ID7": 3}}
    body = {"teams": {"away": {"team": {"id": 1}, "players": {"ID5": player}}, "home": home}}
    found = {r["personId"]: r for r in rows(feeds.boxscore_stats(landed(spark, body, gamePk=77)))}
    assert set(found) == {5, 6} and len(found[5]) == 32
    assert (found[5]["batting_hits"], found[5]["pitching_inningsPitched"], found[5]["battingOrder"]) == (2, "5.2", 100)
    assert found[6]["teamId"] == 2 and found[6]["isInBattingOrder"] is False and found[6]["gamePk"] == 77
    long = feeds.boxscore_long(landed(spark, body, gamePk=77))
    assert {(r["stat_group"], r["stat_key"], r["stat_value"]) for r in rows(long)} == {
        ("batting", "hits", "2"), ("pitching", "inningsPitched", "5.2"),
    }


def test_plays_and_live_feed(spark):
    play = {"about": {"atBatIndex": 0, "inning": 1}, "count": {"balls": 2}, "leverageIndex": 1.25}
    assert rows(feeds.play_by_play(landed(spark, {"allPlays": [play]}, gamePk=3)))[0]["leverageIndex"] == 1.25
    assert feeds.win_probability(landed(spark, [play, "x", 1], {"a": 1}, gamePk=3)).count() == 1
    events = [
        {"isPitch": True, "index": 0, "details": {"type": {"code": "FF"}}, "pitchData": {"startSpeed": 95.5}},
        {"isPitch": False, "index": 1},
        {"index": 2},
    ]
    body = {"liveData": {"plays": {"allPlays": [play | {"playEvents": events}]}}}
    found = rows(feeds.live_feed(landed(spark, body, {"liveData": []}, gamePk=3)))
    assert [(r["pitchIndex"], r["pitchType"], r["releaseSpeed"]) for r in found] == [(0, "FF", 95.5)]


def test_linescore_and_people(spark):
    body = {"innings": [{"num": 1, "home": {"runs": 2}, "away": 4}, 9]}
    assert [(r["inning"], r["homeRuns"], r["awayRuns"]) for r in rows(feeds.linescore(landed(spark, body, gamePk=1)))] == [(1, 2, None)]
    person = {"id": 1, "fullName": "B", "active": True, "primaryPosition": {"code": "8"}, "batSide": None}
    table = feeds.people(landed(spark, {"people": [person]}))
    assert len(table.columns) == 25 and rows(table)[0]["active"] is True
    award = {"id": "MVP", "name": "M", "season": "2021", "team": "x", "player": {"primaryPosition": {"code": "Y"}}}
    assert [(r["season"], r["positionCode"]) for r in rows(feeds.awards(landed(spark, {"awards": [award, 1]}, personId=5)))] == [(2021, "Y")]


def test_stats_forms(spark):
    stats = {"stats": [{"type": {"displayName": "season"}, "splits": [{"season": "2024", "stat": {"hr": 3, "avg": ".300", "n": {"x": 1}}}]}]}
    long = rows(feeds.player_stats(landed(spark, stats, personId=1, group="hitting", statType="career")))
    assert {(r["group"], r["statType"], r["stat_key"], r["stat_value"]) for r in long} == {
        ("hitting", "season", "hr", "3"), ("hitting", "season", "avg", ".300"),
    }
    wide = rows(feeds.team_stats(landed(spark, stats, teamId=1, group="hitting"), {"hr": "bigint", "absent": "double"}))
    assert (wide[0]["hr"], wide[0]["absent"], wide[0]["season"]) == (3, None, 2024)


def test_core_fields_reject_or_fail(spark):
    moves = {"transactions": [{"id": 1, "date": "d", "description": "x", "typeCode": "T", "typeDesc": "t"}, {"id": 2}]}
    df = landed(spark, moves)
    assert feeds.transactions(df, fail=False).count() == 1
    bad = rows(flatten.rejected(df, feeds.TRANSACTIONS))
    assert len(bad) == 1 and "date is missing" in bad[0]["_problems"]
    with pytest.raises(Exception, match="Payload row rejected: date is missing"):
        feeds.transactions(df).collect()
    unreadable = landed(spark, {"people": [{"id": "x1"}]})
    assert rows(flatten.rejected(unreadable, feeds.PEOPLE))[0]["_problems"] == ["id is unreadable"]


def test_arsenal_and_draft(spark):
    stat = {"type": {"code": "FF", "description": "F"}, "percentage": 0.5, "averageSpeed": 95}
    body = {"stats": [{"type": {"displayName": "pitchArsenal"}, "splits": [{"stat": stat}]}, {"type": {}, "splits": [{"stat": {}}]}]}
    assert [(r["pitchTypeCode"], r["averageSpeed"]) for r in rows(feeds.pitch_arsenal(landed(spark, body, personId=1, season=2024), fail=True))] == [("FF", 95.0)]
    picks = [{"round": 1, "pickNumber": 4, "person": {"fullName": "X"}}, {"pickRound": "CB-A", "round": 1, "pickNumber": "5", "person": {"fullName": "Y"}}]
    found = rows(feeds.draft(landed(spark, {"drafts": {"rounds": [{"picks": picks}]}}, year=2024)))
    assert {(r["round"], r["pickNumber"]) for r in found} == {("1", 4), ("CB-A", 5)}


def test_standings(spark):
    team = lambda gb, pct: {"team": {"id": 1, "name": "T"}, "leagueRecord": {"wins": 3, "losses": 1, "pct": pct}, "gamesBack": gb}
    body = {"records": [{"division": {"id": 200, "name": "W"}, "teamRecords": [team("-", ".623"), team("12.5", "0.5"), 7]}, 3]}
    found = rows(feeds.standings(landed(spark, body, season=2024)))
    assert sorted((r["W-L%"], r["GB"]) for r in found if r["GB"]) == [(0.5, 12.5)] and len(found) == 2
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        feeds.standings(landed(spark, {"records": [{"teamRecords": [team("soon", ".5")]}]}, season=2024)).collect()


def test_gamefeed(spark):
    ball = {"batter_name": " A ", "launch_speed": "101.5", "xba": True, "contextMetrics": {"homeRunBallparks": 30}}
    df = landed(spark, {"exit_velocity": [ball]}, {"exit_velocity": {"k": [ball]}}, {}, gamePk=9)
    found = rows(feeds.exit_velocity(df))
    assert len(found) == 2 and all((r["batter_name"], r["launch_speed"], r["xba"], r["home_run_ballparks"]) == ("A", 101.5, None, 30) for r in found)
    body = {"home_pitchers": {"605483": [{"spin_rate": "2300.0", "breakZInducedInches": 1.5}]}, "away_pitchers": [{"pitcher": {"id": "7"}, "inducedBreakZ": 2}]}
    pitches = rows(feeds.pitch_data(landed(spark, body, gamePk=9)))
    assert {(r["pitcher_id"], r["spin_rate"], r["break_z_induced_inches"]) for r in pitches} == {(605483, 2300, 1.5), (7, None, 2.0)}
    wrong = landed(spark, {"exit_velocity": "x"}, {"exit_velocity": [1]}, {"exit_velocity": {"a": 1}}, {"exit_velocity": [ball]}, {})
    assert feeds.gamefeed_problems(wrong, "exit_velocity").count() == 3
    assert feeds.exit_velocity(wrong, fail=False).count() == 1
    for body in ({"exit_velocity": "x"}, {"exit_velocity": [1]}, {"exit_velocity": {"a": 1}}, {"exit_velocity": [None]}):
        with pytest.raises(Exception, match="gamefeed (node|element)"):
            feeds.exit_velocity(landed(spark, body, gamePk=9)).collect()


def test_gamefeed_objects_are_those_read_step_by_step(spark):
    speeds = ['"2"', "1.10", "1e400", "NaN", "Infinity", '"Infinity"', '"\\\\"q"', "true", "null", "[1, 2]", "12345678901234567890123"]
    balls = [f'{{"batter_name": " A ", "launch_speed": {v}, "contextMetrics": {{"homeRunBallparks": "3.0"}}}}' for v in speeds]
    balls += ["{}", "null", "7", '"x"', '{"contextMetrics": "x", "launch_speed": 5}', '{"launch_speed": 1, "launch_speed": 2}']
    nodes = [n for ball in balls for n in (f"[{ball}]", f'{{"k": [{balls[0]}, {ball}], "l": []}}')]
    nodes += ["null", "{}", "[]", '"x"', "1", '{"a": null}', '{"a": {}}', '{"a": [null]}', '[{}], "exit_velocity": {"a": [{}]}', '{"a": [{}]}, "exit_velocity": null']
    bodies = [f'{{"exit_velocity": {n}}}' for n in nodes] + ["", "x", "{}", '{"exit_velocity": [{"launch_speed": 1}', '{"x": "\\"exit_velocity\\": {", "exit_velocity": [{}]}']
    df = spark.createDataFrame([(b, i) for i, b in enumerate(bodies)], "body string, i int")
    leaves = dict.fromkeys(("batter_name", "launch_speed", "contextMetrics.homeRunBallparks"), "string")
    want = feeds.gamefeed_rows(df, "exit_velocity", fail=False).select("i", flatten.parsed(F.col("item"), leaves).alias("parsed_item"))
    got = feeds.gamefeed_objects(df, "exit_velocity", leaves, fail=False)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_highlights(spark):
    item = {
        "id": "", "mediaPlaybackId": "m1", "headline": "H",
        "keywordsAll": [{"type": "player_id"}, {"type": "player_id", "value": "545361"}, "x", {"type": "play_id", "value": "p"}],
        "playbacks": [{"url": "a_450K.mp4"}, {"url": "b_2500K.mp4"}, {"url": "c_2500K.mp4"}, {"name": "n"}],
    }
    body = {"highlights": {"highlights": {"items": [item, {"id": "z", "playbacks": []}, 4]}}}
    found = rows(feeds.highlights(landed(spark, body, {"highlights": []}, gamePk=1)))
    assert [(r["highlightId"], r["playerId"], r["playId"], r["url"]) for r in found] == [("m1", 545361, "p", "b_2500K.mp4")]


def test_clips(spark):
    field = lambda n, v, d=None: {"name": n, "value": v, "displayValue": d}
    play = {
        "id": "c1", "gameDate": "2024-06-01", "title": "T",
        "fields": [field("PlayerId", "592450,1", "Aaron Judge, X"), field("hitResult", "[Hit, Home Run]"), field("exitVelocity", "110.5"), field("hitDistance", "far")],
        "playbacks": [{"name": "hls", "url": "a.m3u8"}, {"name": "mp4 1200K", "url": "a.mp4"}, {"name": "mp4 4K", "url": "b.mp4", "width": 1280}],
    }
    built = {"mediaPlayback": [{"mediaPlaybackId": "m9", "date": "2024-07-04T01:02:03Z", "title": "Z"}], "player_id": 5}
    found = {r["content_id"]: r for r in rows(clips.clips(landed(spark, {"data": {"search": {"plays": [play, built, 3]}}}, {"items": [{"id": "i"}]})))}
    one = found["c1"]
    assert (one["player_id"], one["player_name"], one["event_type"], one["exit_velocity"], one["hit_distance"]) == (
        592450, "Aaron Judge", "Home Run", 110.5, None,
    )
    assert (one["best_mp4_url"], one["hls_url"], one["date"]) == ("b.mp4", "a.m3u8", date(2024, 6, 1))
    assert [p["bitrate"] for p in one["playbacks"]] == [0, 1200, 4000]
    two = found[""]
    assert two["best_mp4_url"].endswith("/2024/2024-07/04/m9_1280x720_59_4000K.mp4") and len(two["playbacks"]) == 1
    assert two["title"] == "Z" and two["player_id"] == 5 and found["i"]["date"] is None
    empty = clips.clips(landed(spark, {"data": {"search": {}}}))
    assert len(empty.columns) == 12 and empty.count() == 0 and types_of(empty)["date"] == "date"


def test_plans_are_checked(spark):
    with pytest.raises(InvalidParameter, match="read as a whole"):
        flatten.json_schema({"a": "string", "a.b": "string"})
    with pytest.raises(InvalidParameter, match="directly"):
        flatten.flatten(landed(spark, {}), Plan((Step("b", "a", "x"),), {"v": ("string", "b:v")}))
    with pytest.raises(InvalidParameter, match="gamePk"):
        feeds.linescore(spark.createDataFrame([("{}",)], "body string"))
    assert flatten.unparsed(landed(spark, "nope", {})).count() == 1


def test_a_fraction_makes_no_id(spark):
    body = '{"venues":[{"id":12.7,"name":"A"},{"id":13.0,"name":"B"},{"id":"zz","name":"C"}]}'
    df = landed(spark, body)
    whole = flatten.flagged(df, feeds.VENUES).collect()
    assert len(whole) == 3 and sorted(len(r["_problems"]) for r in whole) == [0, 1, 1]
    assert [r["id"] for r in feeds.venues(df, fail=False).collect()] == [13]
    with pytest.raises(Exception, match="rejected"):
        feeds.venues(df).collect()


ODD_SCHEDULE = (
    '{"dates": [{"games": [{"gamePk": 1}, 7, null, {"gamePk": 2, "teams": {"away": {"team": 5, "score": 3}}}]}, "x", null, '
    '{"games": "none"}, {"games": [[1], {"gamePk": 3, "teams": {"away": 9}}]}, {"games": {}}]}'
)


def test_odd_elements_at_any_level_do_not_take_their_neighbours_along(spark):
    bodies = [ODD_SCHEDULE, '{"dates": 5}', '{"dates": [{"games": [{"gamePk": 4}]}]}', "[]", "nonsense", None, '{"dates": [{"games": [{"gamePk": 5}]}']
    df = spark.createDataFrame([(b, {}) for b in bodies], "body string, params map<string,string>")
    found = {r.gamePk: r.awayScore for r in feeds.schedule(df).collect()}
    assert {k: v for k, v in found.items() if k != 5} == {1: None, 2: 3, 3: None, 4: None}


def test_odd_values_of_keyed_levels(spark):
    player = {"person": {"id": 1, "fullName": "A"}}
    teams = {"away": {"team": {"id": 9}, "players": {"ID1": player, "ID2": 5, "ID3": None}}, "home": 7, "neutral": {"players": {"ID4": player}}}
    found = feeds.boxscore(landed(spark, {"teams": teams}, gamePk=3)).collect()
    assert [(r.gamePk, r.teamId, r.personId, r.fullName) for r in found] == [(3, 9, 1, "A")]


def test_plain_payloads_give_the_rows_of_their_texts(spark):
    event = lambda **fields: {"isPitch": True, "index": 3, "pitchData": {"startSpeed": 95.1, "breaks": {"spinRate": 2300}}, **fields}
    odd = [5, 5.0, 5.5, "5", "x", "", None, True, "true", [1], {"a": 1}, 10**20, "NaN"]
    plays = [[{"about": {"atBatIndex": v, "playId": v}, "playEvents": [event(), event(index=v, isPitch=False)]}] for v in odd]
    plays += [[{"playEvents": [event(**{k: v}), event(index=4)]}] for k in event() for v in odd]
    plays += [[{"playEvents": [event(), v]}, v, {"playEvents": v}, {"playEvents": [event(index=4)]}] for v in odd]
    bodies = [json.dumps({"liveData": {"plays": {"allPlays": p}}}) for p in plays]
    bodies += [bodies[0].replace("95.1", number) for number in ("NaN", "1e400", "-Infinity", "95", "1E1")] + ["{", "[]", "", None, bodies[0][:-9]]
    landed_ = spark.createDataFrame([(b, {"gamePk": "x" if i == 1 else str(i)}) for i, b in enumerate(bodies)], "body string, params map<string,string>")
    found = lambda **how: sorted(map(repr, flatten.flatten(landed_, feeds.LIVE_FEED, fail=False, **how).collect()))
    assert found(plain=True) == found() and len(found()) > 60
    assert found(plain=True, only="isPitch") == found(only=F.col("isPitch").try_cast("boolean"))
    with pytest.raises(Exception, match="gamePk is unreadable"):
        flatten.flatten(landed_, feeds.LIVE_FEED, plain=True).collect()
