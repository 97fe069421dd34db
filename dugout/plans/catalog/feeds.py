"""Payload plans: rows of a table become JSON payloads and are flattened back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dugout.operators import filters
from dugout.plans import clips, feeds, flatten
from dugout.plans.catalog.base import obj, payloads, query, table

_SQL_TYPES = {"string": "varchar", "bigint": "bigint", "double": "double", "boolean": "boolean", "date": "date"}


def project(columns: dict[str, str], given: dict[str, str]) -> str:
    """Select list with the given expressions and typed nulls for all other columns."""
    return ", ".join(f'({given.get(name, "null")})::{_SQL_TYPES[kind]} as "{name}"' for name, kind in columns.items())


def kinds(plan: flatten.Plan, *without: str) -> dict[str, str]:
    return {name: column[0] for name, column in plan.columns.items() if name not in without}


def text(column: str) -> Column:
    return F.col(column).cast("string")


_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


def _day(column: str = "o_orderdate") -> Column:
    return F.date_format(column, "yyyy-MM-dd")


_SCHEDULE = {
    "gamePk": "o_orderkey", "season": "year(o_orderdate)", "gameDate": _DAY, "officialDate": _DAY,
    "gameType": "o_orderpriority", "statusCode": "o_orderstatus", "awayTeamId": "o_custkey % 30",
    "awayTeamName": "'T' || o_custkey % 30", "awayScore": "case when o_orderkey % 3 != 0 then o_custkey % 11 end",
    "homeTeamId": "o_orderkey % 30", "doubleHeader": "'false'", "homeHits": "o_orderkey % 15",
    "winnerPitcherId": "case when o_orderkey % 2 = 0 then o_custkey end",
    "winnerPitcherName": "case when o_orderkey % 2 = 0 then 'P' || o_custkey end", "scheduledInnings": "9",
}


@query(f"select {project(kinds(feeds.SCHEDULE), _SCHEDULE)} from orders")
def feed_schedule(spark, folder):
    key, other = F.col("o_orderkey"), F.col("o_custkey")
    game = obj(
        gamePk=text("o_orderkey"),
        season=F.year("o_orderdate"),
        gameDate=_day(),
        officialDate=_day(),
        gameType=F.col("o_orderpriority"),
        doubleHeader=False,
        scheduledInnings=9,
        status=obj(statusCode=F.col("o_orderstatus")),
        teams=obj(
            away=obj(
                team=obj(id=other % 30, name=F.concat(F.lit("T"), (other % 30).cast("string"))),
                score=F.when(key % 3 != 0, other % 11),
            ),
            home=obj(team=obj(id=key % 30)),
        ),
        linescore=obj(teams=obj(home=obj(hits=key % 15), away="not an object")),
        decisions=F.when(
            key % 2 == 0, obj(winner=obj(id=other, fullName=F.concat(F.lit("P"), other.cast("string"))))
        ),
    )
    landed = payloads(table(spark, folder, "orders"), obj(dates=F.array(obj(games=F.array(game)))))
    return feeds.schedule(landed)


_BOX_KINDS = {**kinds(feeds.BOXSCORE, "battingOrderText"), **feeds.BOX_STATS, "isInBattingOrder": "boolean", "battingOrder": "bigint"}
_BOX_AWAY = {
    "gamePk": "o_orderkey", "teamId": "o_custkey % 30", "personId": "o_custkey", "fullName": "'A' || o_custkey",
    "positionCode": "(o_orderkey % 7)", "batting_hits": "o_orderkey % 50", "pitching_inningsPitched": "'5.2'",
    "isInBattingOrder": "o_orderkey % 7 != 3", "battingOrder": "case when o_orderkey % 7 != 3 then (o_orderkey % 7) * 100 end",
}
_BOX_HOME = {
    "gamePk": "o_orderkey", "personId": "o_custkey % 30", "fullName": "'H'", "isInBattingOrder": "false", "fielding_errors": "1",
}


def _boxscores(spark, folder):
    line, part = (F.col("o_orderkey") % 7), F.col("o_custkey")
    away = obj(
        person=obj(id=part, fullName=F.concat(F.lit("A"), part.cast("string"))),
        position=obj(code=line.cast("string")),
        battingOrder=F.when(line != 3, (line * 100).cast("string")).otherwise(""),
        stats=obj(
            batting=obj(hits=(F.col("o_orderkey") % 50).cast("bigint"), nested=obj(x=1)),
            pitching=obj(inningsPitched="5.2"),
        ),
    )
    home = obj(person=obj(id=(F.col("o_custkey") % 30), fullName="H"), stats=obj(fielding=obj(errors=1)))
    box = obj(
        teams=obj(
            away=obj(team=obj(id=(F.col("o_custkey") % 30)), players=F.create_map(F.concat(F.lit("ID"), part.cast("string")), away)),
            home=obj(players=F.create_map(F.lit("ID1"), home)),
            neutral=obj(players=F.create_map(F.lit("ID1"), home)),
        )
    )
    return payloads(table(spark, folder, "orders"), box, {"gamePk": F.col("o_orderkey")})


@query(f"select {project(_BOX_KINDS, _BOX_AWAY)} from orders union all select {project(_BOX_KINDS, _BOX_HOME)} from orders")
def feed_boxscore_stats(spark, folder):
    return feeds.boxscore_stats(_boxscores(spark, folder))


_BOX_FEW = {k: v for k, v in _BOX_KINDS.items() if k not in feeds.BOX_STATS}


@query(f"select {project(_BOX_FEW, _BOX_AWAY)} from orders union all select {project(_BOX_FEW, _BOX_HOME)} from orders")
def feed_boxscore(spark, folder):
    return feeds.boxscore(_boxscores(spark, folder))


@query("""
select o_orderkey::bigint as "gamePk", o_custkey as "personId", 'batting' as stat_group, 'hits' as stat_key, (o_orderkey % 50)::bigint::varchar as stat_value from orders
union all select o_orderkey, o_custkey, 'pitching', 'inningsPitched', '5.2' from orders
union all select o_orderkey, o_custkey % 30, 'fielding', 'errors', '1' from orders""")
def feed_boxscore_long(spark, folder):
    return feeds.boxscore_long(_boxscores(spark, folder)).select("gamePk", "personId", "stat_group", "stat_key", "stat_value")


_PLAY = {
    "gamePk": "l_orderkey", "atBatIndex": "l_linenumber", "inning": "l_linenumber % 9", "halfInning": "l_returnflag",
    "batterId": "l_partkey", "pitcherId": "l_suppkey", "event": "l_linestatus", "balls": "l_quantity", "rbi": "0",
    "homeTeamWinProbability": "l_discount * 100",
}


def _play():
    return obj(
        about=obj(atBatIndex=F.col("l_linenumber"), inning=F.col("l_linenumber") % 9, halfInning=F.col("l_returnflag")),
        matchup=obj(batter=obj(id=F.col("l_partkey")), pitcher=obj(id=F.col("l_suppkey"))),
        result=obj(event=F.col("l_linestatus"), rbi=0),
        count=obj(balls=F.col("l_quantity")),
        homeTeamWinProbability=F.col("l_discount") * 100,
    )


@query(f"select {project(kinds(feeds.PLAY_BY_PLAY), _PLAY)} from lineitem")
def feed_play_by_play(spark, folder):
    plays = obj(allPlays=F.array(_play()))
    return feeds.play_by_play(payloads(table(spark, folder, "lineitem"), plays, {"gamePk": F.col("l_orderkey")}))


@query(f"select {project(kinds(feeds.WIN_PROBABILITY), _PLAY)} from lineitem where l_linenumber % 2 = 0")
def feed_win_probability(spark, folder):
    """Bare arrays with an element that is no object; odd lines send an object instead."""
    lines = table(spark, folder, "lineitem")
    bare = F.concat(F.lit("[7, "), F.to_json(_play()), F.lit(', "x"]'))
    body = F.when(F.col("l_linenumber") % 2 == 0, bare).otherwise(F.to_json(obj(note="empty")))
    params = F.create_map(F.lit("gamePk"), text("l_orderkey"))
    return feeds.win_probability(lines.select(body.alias("body"), params.alias("params")))


_LIVE = {
    "gamePk": "l_orderkey", "atBatIndex": "l_linenumber", "pitchIndex": "l_suppkey", "playId": "l_returnflag",
    "event": "l_linestatus", "pitchType": "'FF'", "releaseSpeed": "l_extendedprice", "spinRate": "2300", "batterId": "l_partkey",
}


def live_payload() -> Column:
    event = lambda pitch, index: obj(
        isPitch=pitch,
        index=index,
        details=obj(event=F.col("l_linestatus"), type=obj(code="FF")),
        pitchData=obj(startSpeed=F.col("l_extendedprice"), breaks=obj(spinRate=2300)),
    )
    play = obj(
        about=obj(atBatIndex=F.col("l_linenumber"), playId=F.col("l_returnflag")),
        matchup=obj(batter=obj(id=F.col("l_partkey"))),
        playEvents=F.array(event(F.lit(True), F.col("l_suppkey")), event(F.lit(False), F.col("l_suppkey") * 0)),
    )
    return obj(liveData=obj(plays=obj(allPlays=F.array(play))))


@query(f"select {project(kinds(feeds.LIVE_FEED, 'isPitch'), _LIVE)} from lineitem")
def feed_live(spark, folder):
    lines = table(spark, folder, "lineitem")
    return feeds.live_feed(payloads(lines, live_payload(), {"gamePk": F.col("l_orderkey")}))


@query(f"""
select {project(kinds(feeds.LINESCORE), {"gamePk": "o_orderkey", "inning": "1", "homeRuns": "o_custkey % 5", "awayHits": "o_custkey % 7"})} from orders
union all select {project(kinds(feeds.LINESCORE), {"gamePk": "o_orderkey", "inning": "2"})} from orders""")
def feed_linescore(spark, folder):
    first = obj(num=1, home=obj(runs=F.col("o_custkey") % 5), away=obj(hits=F.col("o_custkey") % 7))
    body = F.concat(F.lit('{"innings":['), F.to_json(first), F.lit(',{"num":2,"home":"none","away":3},"extra"]}'))
    params = F.create_map(F.lit("gamePk"), text("o_orderkey"))
    return feeds.linescore(table(spark, folder, "orders").select(body.alias("body"), params.alias("params")))


_PERSON = {
    "id": "c_custkey", "fullName": "c_name", "currentAge": "c_nationkey", "active": "c_custkey % 2 = 0",
    "primaryPositionCode": "c_mktsegment", "batSideCode": "'R'", "weight": "200",
}


@query(f"select {project(kinds(feeds.PEOPLE), _PERSON)} from customer")
def feed_people(spark, folder):
    person = obj(
        id=F.col("c_custkey"),
        fullName=F.col("c_name"),
        currentAge=text("c_nationkey"),
        active=F.col("c_custkey") % 2 == 0,
        weight=200,
        primaryPosition=obj(code=F.col("c_mktsegment")),
        batSide=obj(code="R"),
    )
    return feeds.people(payloads(table(spark, folder, "customer"), obj(people=F.array(person))))


_AWARD = {
    "personId": "c_custkey", "awardId": "c_mktsegment", "awardName": "c_name", "season": "2000 + c_nationkey",
    "teamId": "case when c_custkey % 2 = 0 then c_nationkey end", "positionCode": "'5'",
}


@query(f"select {project(kinds(feeds.AWARDS), _AWARD)} from customer")
def feed_awards(spark, folder):
    award = obj(
        id=F.col("c_mktsegment"),
        name=F.col("c_name"),
        season=(F.col("c_nationkey") + 2000).cast("string"),
        team=F.when(F.col("c_custkey") % 2 == 0, obj(id=F.col("c_nationkey"))),
        player=obj(primaryPosition=obj(code="5")),
    )
    landed = payloads(table(spark, folder, "customer"), obj(awards=F.array(award)), {"personId": F.col("c_custkey")})
    return feeds.awards(landed)


@query(f"""select {project(kinds(feeds.ROSTER), {"teamId": "c_nationkey", "personId": "c_custkey", "fullName": "c_name",
    "jerseyNumber": "c_custkey % 99", "positionCode": "c_mktsegment", "statusCode": "'A'"})} from customer""")
def feed_roster(spark, folder):
    entry = obj(
        person=obj(id=F.col("c_custkey"), fullName=F.col("c_name")),
        jerseyNumber=(F.col("c_custkey") % 99).cast("string"),
        position=obj(code=F.col("c_mktsegment")),
        status=obj(code="A"),
    )
    landed = payloads(table(spark, folder, "customer"), obj(roster=F.array(entry)), {"teamId": F.col("c_nationkey")})
    return feeds.roster(landed)


def _splits(spark, folder, params):
    stat = obj(hits=F.col("l_quantity").cast("bigint"), avg=F.concat(F.lit("."), text("l_suppkey")), nested=obj(x=1))
    stats = obj(
        group=F.when(F.col("l_linenumber") % 2 == 0, obj(displayName="hitting")),
        type=F.when(F.col("l_linenumber") % 3 == 0, obj(displayName="career")),
        splits=F.array(obj(season=F.year("l_shipdate").cast("string"), stat=stat)),
    )
    return payloads(table(spark, folder, "lineitem"), obj(stats=F.array(stats)), params)


_SPLIT_FIXED = """year(l_shipdate)::bigint as season,
  case when l_linenumber % 2 = 0 then 'hitting' else 'pitching' end as "group" """


@query(f"""
with r as (select l_partkey as "personId", {_SPLIT_FIXED}, case when l_linenumber % 3 = 0 then 'career' else 'yearByYear' end as "statType",
           l_quantity, l_suppkey from lineitem)
select "personId", season, "group", "statType", 'hits' as stat_key, l_quantity::bigint::varchar as stat_value from r
union all select "personId", season, "group", "statType", 'avg', '.' || l_suppkey from r""")
def feed_player_stats(spark, folder):
    params = {"personId": F.col("l_partkey"), "group": F.lit("pitching"), "statType": F.lit("yearByYear")}
    return feeds.player_stats(_splits(spark, folder, params))


@query(f"""
select l_suppkey as "teamId", {_SPLIT_FIXED}, case when l_linenumber % 3 = 0 then 'career' else 'season' end as "statType",
       l_quantity::bigint as hits, '.' || l_suppkey as avg from lineitem""")
def feed_team_stats(spark, folder):
    landed = _splits(spark, folder, {"teamId": F.col("l_suppkey"), "group": F.lit("pitching")})
    return feeds.team_stats(landed, {"hits": "bigint", "avg": "string"})


@query(f"""select {project(kinds(feeds.STAT_LEADERS), {"rank": "l_linenumber", "personId": "l_partkey", "teamId": "l_suppkey",
    "category": "case when l_linenumber % 4 = 0 then 'unknown' else l_returnflag end", "value": "l_extendedprice", "season": "2024",
    "statGroup": "'hitting'"})} from lineitem""")
def feed_stat_leaders(spark, folder):
    entry = obj(
        rank=F.col("l_linenumber"),
        person=obj(id=F.col("l_partkey")),
        team=obj(id=F.col("l_suppkey")),
        value=text("l_extendedprice"),
    )
    board = obj(
        leaderCategory=F.when(F.col("l_linenumber") % 4 != 0, F.col("l_returnflag")), leaders=F.array(entry)
    )
    params = {"season": F.lit(2024), "statGroup": F.lit("hitting")}
    return feeds.stat_leaders(payloads(table(spark, folder, "lineitem"), obj(leagueLeaders=F.array(board)), params))


def _arsenals(spark, folder):
    line = F.col("l_linenumber")
    code = obj(code=F.col("l_returnflag"), description=F.when(line % 5 != 0, F.col("l_linestatus")))
    split = obj(
        stat=obj(
            type=F.when(line % 2 == 0, code),
            pitchType=F.when(line % 2 == 1, code),
            percentage=F.col("l_discount"),
            averageSpeed=F.col("l_extendedprice"),
        )
    )
    kind = F.when(F.col("l_partkey") % 3 != 0, "pitchArsenal").otherwise("season")
    stats = obj(type=obj(displayName=kind), splits=F.array(split))
    params = {"personId": F.col("l_partkey"), "season": F.year("l_shipdate")}
    return payloads(table(spark, folder, "lineitem"), obj(stats=F.array(stats)), params)


@query(f"""select {project(kinds(feeds.PITCH_ARSENAL, 'statType'), {"personId": "l_partkey", "season": "year(l_shipdate)",
    "pitchTypeCode": "l_returnflag", "pitchTypeName": "l_linestatus", "percentage": "l_discount", "averageSpeed": "l_extendedprice"})}
from lineitem where l_partkey % 3 != 0 and l_linenumber % 5 != 0""")
def feed_pitch_arsenal(spark, folder):
    return feeds.pitch_arsenal(_arsenals(spark, folder), fail=False)


@query("""
select l_partkey as "personId", 'pitchTypeName is missing' as problem from lineitem where l_linenumber % 5 = 0""")
def feed_rejects(spark, folder):
    bad = flatten.rejected(_arsenals(spark, folder), feeds.PITCH_ARSENAL)
    return bad.select("personId", F.explode(flatten.PROBLEMS).alias("problem"))


@query(f"""select {project(kinds(feeds.DRAFT), {"year": "year(o_orderdate)", "round": "case when o_orderkey % 2 = 0 then 'CB-A' else (o_orderkey % 20)::varchar end",
    "pickNumber": "o_custkey", "playerName": "o_orderpriority", "teamId": "o_orderkey % 30", "signingBonus": "floor(o_totalprice)"})} from orders""")
def feed_draft(spark, folder):
    pick = obj(
        pickRound=F.when(F.col("o_orderkey") % 2 == 0, "CB-A"),
        round=F.col("o_orderkey") % 20,
        pickNumber=F.col("o_custkey"),
        person=obj(fullName=F.col("o_orderpriority")),
        team=obj(id=F.col("o_orderkey") % 30),
        signingBonus=F.floor("o_totalprice"),
    )
    body = obj(drafts=obj(rounds=F.array(obj(picks=F.array(pick)))))
    return feeds.draft(payloads(table(spark, folder, "orders"), body, {"year": F.year("o_orderdate")}))


@query(f"""select {project(kinds(feeds.TRANSACTIONS), {"id": "o_orderkey", "date": _DAY, "description": "o_orderpriority",
    "typeCode": "o_orderstatus", "typeDesc": "'Trade'", "playerId": "o_custkey", "toTeamId": "o_custkey % 30"})} from orders where o_orderkey % 10 != 0""")
def feed_transactions(spark, folder):
    move = obj(
        id=text("o_orderkey"),
        date=_day(),
        description=F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")),
        typeCode=F.col("o_orderstatus"),
        typeDesc="Trade",
        person=obj(id=F.col("o_custkey")),
        toTeam=obj(id=F.col("o_custkey") % 30),
    )
    return feeds.transactions(payloads(table(spark, folder, "orders"), obj(transactions=F.array(move))), fail=False)


@query(f"""select {project(kinds(feeds.VENUES), {"id": "s_suppkey", "name": "s_name", "active": "true", "season": "2024"})} from supplier""")
def feed_venues(spark, folder):
    venue = obj(id=F.col("s_suppkey"), name=F.col("s_name"), active=True, season=2024)
    return feeds.venues(payloads(table(spark, folder, "supplier"), obj(venues=F.array(venue))))


@query(f"""select {project(kinds(feeds.TEAMS), {"id": "s_suppkey", "name": "s_name", "leagueId": "s_nationkey % 2", "divisionId": "s_nationkey",
    "springLeague": "'Cactus'", "season": "2024"})} from supplier""")
def feed_teams(spark, folder):
    team = obj(
        id=F.col("s_suppkey"),
        name=F.col("s_name"),
        league=obj(id=F.col("s_nationkey") % 2),
        division=obj(id=F.col("s_nationkey")),
        springLeague=obj(name="Cactus"),
    )
    landed = payloads(table(spark, folder, "supplier"), obj(teams=F.array(team)), {"season": F.lit(2024)})
    return feeds.teams(landed)


@query(f"""select {project(kinds(feeds.DIVISIONS), {"id": "n_nationkey", "name": "n_name", "leagueId": "n_regionkey", "hasWildcard": "true", "sortOrder": "n_nationkey * 2"})} from nation""")
def feed_divisions(spark, folder):
    division = obj(
        id=F.col("n_nationkey"), name=F.col("n_name"), league=obj(id=F.col("n_regionkey")), hasWildcard=True,
        sortOrder=F.col("n_nationkey") * 2,
    )
    return feeds.divisions(payloads(table(spark, folder, "nation"), obj(divisions=F.array(division))))


@query(f"""select {project(kinds(feeds.LEAGUES), {"id": "n_nationkey", "name": "n_name", "sportId": "n_regionkey", "numTeams": "15", "hasWildCard": "false"})} from nation""")
def feed_leagues(spark, folder):
    league = obj(
        id=F.col("n_nationkey"), name=F.col("n_name"), sport=obj(id=F.col("n_regionkey")), numTeams="15", hasWildCard=False
    )
    return feeds.leagues(payloads(table(spark, folder, "nation"), obj(leagues=F.array(league))))


_STANDING_KINDS = {**kinds(feeds.STANDINGS), "W-L%": "double", "GB": "double"}


@query(f"""select {project(_STANDING_KINDS, {"season": "2024", "division_id": "o_custkey % 6", "teamId": "o_orderkey", "Tm": "o_orderpriority",
    "W": "o_custkey % 100", "L": "62", "W-L%": "0.623", "GB": "case o_orderkey % 3 when 0 then 12.5 end"})} from orders""")
def feed_standings(spark, folder):
    back = F.when(F.col("o_orderkey") % 3 == 0, "12.5").when(F.col("o_orderkey") % 3 == 1, "-").otherwise("Tied")
    team = obj(
        team=obj(id=F.col("o_orderkey"), name=F.col("o_orderpriority")),
        leagueRecord=obj(wins=F.col("o_custkey") % 100, losses=62, pct=".623"),
        gamesBack=back,
    )
    record = obj(division=obj(id=F.col("o_custkey") % 6), teamRecords=F.array(team))
    landed = payloads(table(spark, folder, "orders"), obj(records=F.array(record)), {"season": F.lit(2024)})
    return feeds.standings(landed)


_CLIP_SQL = """
with c as (select o_orderkey as k, o_custkey as p, o_orderdate::date as d, (o_custkey % 4000)::bigint as rate from orders)
select 'c' || k as content_id, d as date, 'T' || k as title, '' as blurb, p as player_id, 'Player ' || p as player_name,
       case when k % 2 = 0 then 'Home Run' else 'Single' end as event_type, (k % 100) + 0.5 as exit_velocity,
       case when k % 4 = 0 then null else (300 + k % 100)::bigint end as hit_distance,
       case when k % 3 = 0 then 'https://mlb-cuts-diamond.mlb.com/FORGE/' || strftime(d, '%Y/%Y-%m/%d') || '/m' || k || '_1280x720_59_4000K.mp4'
            else 'u' || k || '_' || rate || 'K.mp4' end as best_mp4_url,
       case when k % 3 = 0 then 's' || k || '.m3u8' end as hls_url, case when k % 3 = 0 then 2 else 1 end as n_playbacks from c"""


def _clip_payloads(spark, folder):
    key, player = F.col("o_orderkey"), F.col("o_custkey")
    number = lambda c: c.cast("string")
    field = lambda name, value, shown=None: F.struct(
        F.lit(name).alias("name"), value.alias("value"), F.lit(shown).cast("string").alias("displayValue") if not isinstance(shown, Column) else shown.alias("displayValue")
    )
    rate = number(player % 4000)
    listed = obj(name="mp4Avc", url=F.concat(F.lit("u"), number(key), F.lit("_"), rate, F.lit("K.mp4")))
    stream = obj(name="hls", url=F.concat(F.lit("s"), number(key), F.lit(".m3u8")))
    play = obj(
        id=F.concat(F.lit("c"), number(key)),
        gameDate=F.concat(_day(), F.lit("T00:00:00Z")),
        title=F.concat(F.lit("T"), number(key)),
        mediaPlaybackId=F.concat(F.lit("m"), number(key)),
        fields=F.array(
            field("PlayerID", F.concat(number(player), F.lit(",2")), F.concat(F.lit("Player "), number(player), F.lit(", Other"))),
            field("eventType", F.when(key % 2 == 0, "[Hit, Home Run]").otherwise("[Single, play]")),
            field("exitVelocity", F.concat(number(key % 100), F.lit(".5"))),
            field("hitDistance", F.when(key % 4 == 0, "far").otherwise(F.concat(number(key % 100 + 300), F.lit(".0")))),
        ),
        playbacks=F.array(F.when(key % 3 == 0, stream).otherwise(listed)),
    )
    return payloads(table(spark, folder, "orders"), obj(data=obj(search=obj(plays=F.array(play)))))


@query(_CLIP_SQL)
def feed_clips(spark, folder):
    found = clips.clips(_clip_payloads(spark, folder))
    return found.withColumn("n_playbacks", F.size("playbacks")).drop("playbacks")


@query(f"""
with f as ({_CLIP_SQL}) select content_id, date, player_id, exit_velocity from f
where event_type = 'Home Run' and exit_velocity >= 20 and exit_velocity <= 80 and hit_distance >= 320
order by date desc, content_id desc limit 25""")
def feed_clip_search(spark, folder):
    found = filters.clip_search(
        clips.clips(_clip_payloads(spark, folder)),
        {"event_type": ["Home Run"]},
        {"exit_velocity": (20.0, 80.0), "hit_distance": (320, None)},
        ("date", "content_id"),
        limit=25,
    )
    return found.select("content_id", "date", "player_id", "exit_velocity")


@query(f"""
with f as ({_CLIP_SQL}) select content_id, date, event_type from f where event_type = 'Home Run'
order by date desc, content_id desc limit 25""")
def feed_clip_default(spark, folder):
    found = filters.find_clips(clips.clips(_clip_payloads(spark, folder)), newest=("date", "content_id"), limit=25)
    return found.select("content_id", "date", "event_type")


@query("""
select o_orderkey as "gamePk", 'h' || o_orderkey as "highlightId", case when o_orderkey % 2 = 0 then 'p' || o_custkey end as "playId",
       case when o_orderkey % 5 != 0 then o_custkey end as "playerId", o_orderpriority as title,
       'v_' || greatest(o_custkey % 4000, 450) || 'K.mp4' as url
from orders where o_orderkey % 7 != 0""")
def feed_highlights(spark, folder):
    key, player = F.col("o_orderkey"), F.col("o_custkey")
    best = F.greatest(player % 4000, F.lit(450)).cast("string")
    word = lambda kind, value: obj(type=kind, value=value)
    some = key % 7 != 0
    item = obj(
        id=F.when(key % 2 == 0, F.concat(F.lit("h"), key.cast("string"))),
        mediaPlaybackId=F.concat(F.lit("h"), key.cast("string")),
        headline=F.col("o_orderpriority"),
        keywordsAll=F.array(
            word("player_id", F.when(key % 5 != 0, player.cast("string")).otherwise("unknown")),
            word("play_id", F.when(key % 2 == 0, F.concat(F.lit("p"), player.cast("string")))),
            word("player_id", F.lit("1")),
        ),
        playbacks=F.when(
            some,
            F.array(
                obj(url=F.lit("v_plain.mp4")),
                obj(url=F.concat(F.lit("v_"), best, F.lit("K.mp4"))),
                obj(url=F.lit("v_100K.mp4")),
            ),
        ),
    )
    body = obj(highlights=obj(highlights=obj(items=F.array(item))))
    found = feeds.highlights(payloads(table(spark, folder, "orders"), body, {"gamePk": key}))
    return found.select("gamePk", "highlightId", "playId", "playerId", "title", "url")


@query("""
select l_orderkey::bigint as game_pk, 'B' || l_partkey as batter_name, case when l_partkey % 4 = 0 then null when l_partkey % 4 = 1 then null else l_quantity end as launch_speed,
       l_linenumber::bigint as home_run_ballparks from lineitem""")
def feed_exit_velocity(spark, folder):
    """Half of the payloads hold a list, half an object of lists."""
    part = F.col("l_partkey")
    speed = F.when(part % 4 == 0, "N/A").when(part % 4 == 2, text("l_quantity")).when(part % 4 == 3, F.concat(F.lit(" "), text("l_quantity")))
    ball = obj(
        batter_name=F.concat(F.lit(" B"), part.cast("string"), F.lit(" ")),
        launch_speed=speed,
        contextMetrics=obj(homeRunBallparks=F.concat(text("l_linenumber"), F.lit(".0"))),
    )
    as_list, as_map = obj(exit_velocity=F.array(ball)), obj(exit_velocity=F.create_map(part.cast("string"), F.array(ball)))
    lines = table(spark, folder, "lineitem")
    body = F.when(F.col("l_linenumber") % 2 == 0, F.to_json(as_list)).otherwise(F.to_json(as_map))
    params = F.create_map(F.lit("gamePk"), text("l_orderkey"))
    rows = feeds.exit_velocity(lines.select(body.alias("body"), params.alias("params")))
    return rows.select("game_pk", "batter_name", "launch_speed", "home_run_ballparks")


@query("""
select l_orderkey::bigint as game_pk, l_suppkey as pitcher_id, 'home' as pitch_name, 2300::bigint as spin_rate, l_discount as break_z_induced_inches from lineitem
union all select l_orderkey, case l_linenumber % 3 when 0 then l_partkey when 1 then l_partkey + 1 end, 'away', null, l_tax from lineitem""")
def feed_pitch_data(spark, folder):
    line, part = F.col("l_linenumber"), F.col("l_partkey")
    home = obj(pitch_name="home", spin_rate=2300, breakZInducedInches=F.col("l_discount"), pitcher_id=1)
    away = obj(
        pitch_name="away",
        spin_rate=True,
        inducedBreakZ=F.col("l_tax"),
        player_id=F.when(line % 3 == 0, part.cast("string")),
        pitcher=F.when(line % 3 == 1, obj(id=part + 1)),
    )
    body = obj(home_pitchers=F.create_map(text("l_suppkey"), F.array(home)), away_pitchers=F.array(away))
    landed = payloads(table(spark, folder, "lineitem"), body, {"gamePk": F.col("l_orderkey")})
    return feeds.pitch_data(landed).select("game_pk", "pitcher_id", "pitch_name", "spin_rate", "break_z_induced_inches")


@query("select event_id, (props::json->>'k')::bigint as k from events")
def json_scalar(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", flatten.parsed(F.col("props"), {"k": "bigint"})["k"].alias("k"))


@query("select event_id, 'props' as stat_group, 'k' as stat_key, props::json->>'k' as stat_value from events")
def json_long(spark, folder):
    landed = table(spark, folder, "events").select("event_id", F.col("props").alias("body"))
    plan = flatten.Plan((), {"event_id": ("bigint", "@event_id")})
    return flatten.long_form(landed, plan, {"props": "payload:$"})


@query("select o_orderkey, o_custkey as id, o_totalprice as price from orders")
def variant_list_or_map(spark, folder):
    orders = table(spark, folder, "orders")
    item = obj(id=F.col("o_custkey"), price=F.col("o_totalprice"))
    as_list, as_map = F.to_json(obj(rows=F.array(item))), F.to_json(obj(rows=F.create_map(text("o_custkey"), item)))
    landed = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, as_list).otherwise(as_map).alias("body"))
    return feeds.list_or_map(landed, "rows", {"id": ("bigint", "id"), "price": ("double", "price")})


@query("""
select o_orderkey, l_linenumber, l_partkey, l_quantity from orders join lineitem on l_orderkey = o_orderkey""")
def nested_roundtrip(spark, folder):
    """Lines nested below their order as JSON text and flattened back."""
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    line = obj(number=F.col("l_linenumber"), part=F.col("l_partkey"), quantity=F.col("l_quantity"))
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey)
    landed = payloads(joined, obj(order=F.col("o_orderkey"), lines=F.array(line)))
    plan = flatten.Plan(
        (flatten.Step("line", "payload", "lines"),),
        {
            "o_orderkey": ("bigint", "payload:order"),
            "l_linenumber": ("bigint", "line:number"),
            "l_partkey": ("bigint", "line:part"),
            "l_quantity": ("double", "line:quantity"),
        },
    )
    return flatten.flatten(landed, plan).withColumn("l_linenumber", F.col("l_linenumber").cast("int"))
