"""Payload plans for games, people, teams and stats, one per landed endpoint.

Request keys that are not in the payload (game, team, person, season) come from
``params`` of the landing table, written ``@name``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.functions import clean
from dugout.operators.names import once, ref, refs
from dugout.operators.ranks import best_item
from dugout.plans.flatten import (
    LIST,
    OBJECT,
    REPORT,
    ROOT,
    Plan,
    Step,
    field_at,
    flatten,
    inside,
    is_object,
    json_schema,
    long_form,
    objects,
    parsed,
    walk,
    wide_form,
)
from dugout.sources.schemas import B, D, L, S


# Fixed values, here and in the plans below: column names, their types, and where
# a payload holds them.


def _fields(level: str, kinds: dict[str, str]) -> dict[str, tuple[str, str]]:
    """Columns that carry their payload name."""
    return {name: (kind, f"{level}:{name}") for name, kind in kinds.items()}


def _team_side(side: str) -> dict[str, tuple[str, str]]:
    at = f"game:teams.{side}"
    return {
        f"{side}TeamId": (L, f"{at}.team.id"),
        f"{side}TeamName": (S, f"{at}.team.name"),
        f"{side}Score": (L, f"{at}.score"),
        f"{side}ProbablePitcherId": (L, f"{at}.probablePitcher.id"),
        f"{side}ProbablePitcherName": (S, f"{at}.probablePitcher.fullName"),
    }


def _line(side: str) -> dict[str, tuple[str, str]]:
    at = f"game:linescore.teams.{side}"
    return {f"{side}Hits": (L, f"{at}.hits"), f"{side}Errors": (L, f"{at}.errors")}


def _decision(kind: str) -> dict[str, tuple[str, str]]:
    at = f"game:decisions.{kind}"
    return {f"{kind}PitcherId": (L, f"{at}.id"), f"{kind}PitcherName": (S, f"{at}.fullName")}


SCHEDULE = Plan(
    (Step("date", "payload", "dates"), Step("game", "date", "games")),
    {
        **_fields("game", {"gamePk": L, "gameType": S, "season": S, "gameDate": S, "officialDate": S}),
        "statusAbstract": (S, "game:status.abstractGameState"),
        "statusCode": (S, "game:status.statusCode"),
        "statusDetailed": (S, "game:status.detailedState"),
        **_team_side("away"),
        **_team_side("home"),
        "venueId": (L, "game:venue.id"),
        "venueName": (S, "game:venue.name"),
        **_fields(
            "game",
            {
                "doubleHeader": S, "gamedayType": S, "tiebreaker": S, "calendarEventID": S,
                "seasonDisplay": S, "dayNight": S, "description": S, "scheduledInnings": L,
                "gamesInSeries": L, "seriesGameNumber": L, "seriesDescription": S,
            },
        ),
        **_line("away"),
        **_line("home"),
        **_decision("winner"),
        **_decision("loser"),
        **_decision("save"),
    },
)

_BOX_COLUMNS = {
    "gamePk": (L, "@gamePk"),
    "teamId": (L, "side:team.id"),
    "personId": (L, "player:person.id"),
    "fullName": (S, "player:person.fullName"),
    "jerseyNumber": (S, "player:jerseyNumber"),
    "positionCode": (S, "player:position.code"),
    "positionName": (S, "player:position.name"),
    "positionAbbrev": (S, "player:position.abbreviation"),
    "battingOrderText": (S, "player:battingOrder"),
}
BOXSCORE = Plan(
    (
        Step("side", "payload", "teams", keyed=True, keys=("away", "home")),
        Step("player", "side", "players", keyed=True),
    ),
    _BOX_COLUMNS,
)
BOX_GROUPS = {
    "batting": "player:stats.batting",
    "pitching": "player:stats.pitching",
    "fielding": "player:stats.fielding",
}
# Declared boxscore stats.
BOX_STATS = {
    "batting_atBats": L, "batting_runs": L, "batting_hits": L, "batting_doubles": L,
    "batting_triples": L, "batting_homeRuns": L, "batting_rbi": L, "batting_baseOnBalls": L,
    "batting_strikeOuts": L, "batting_leftOnBase": L, "batting_groundIntoDoublePlay": L,
    "batting_stolenBases": L, "batting_caughtStealing": L, "fielding_errors": L,
    "pitching_inningsPitched": S, "pitching_hits": L, "pitching_runs": L, "pitching_earnedRuns": L,
    "pitching_baseOnBalls": L, "pitching_strikeOuts": L, "pitching_homeRuns": L, "pitching_outs": L,
}

_PLAY = {
    "gamePk": (L, "@gamePk"),
    "atBatIndex": (L, "play:about.atBatIndex"),
    "inning": (L, "play:about.inning"),
    "halfInning": (S, "play:about.halfInning"),
    "batterId": (L, "play:matchup.batter.id"),
    "batterName": (S, "play:matchup.batter.fullName"),
    "pitcherId": (L, "play:matchup.pitcher.id"),
    "pitcherName": (S, "play:matchup.pitcher.fullName"),
    "description": (S, "play:result.description"),
    "event": (S, "play:result.event"),
    "eventType": (S, "play:result.eventType"),
    "balls": (L, "play:count.balls"),
    "strikes": (L, "play:count.strikes"),
    "outs": (L, "play:count.outs"),
    "homeScore": (L, "play:result.homeScore"),
    "awayScore": (L, "play:result.awayScore"),
    "rbi": (L, "play:result.rbi"),
    **_fields(
        "play",
        {
            "homeTeamWinProbability": D, "awayTeamWinProbability": D, "homeTeamWinProbabilityAdded": D,
            "leverageIndex": D, "dramaIndex": D,
        },
    ),
}
PLAY_BY_PLAY = Plan((Step("play", "payload", "allPlays"),), _PLAY)
WIN_PROBABILITY = Plan((Step("play", "payload", "$"),), _PLAY)

LIVE_FEED = Plan(
    (Step("play", "payload", "liveData.plays.allPlays"), Step("event", "play", "playEvents")),
    {
        "gamePk": (L, "@gamePk"),
        "atBatIndex": (L, "play:about.atBatIndex"),
        "pitchIndex": (L, "event:index"),
        "pitchNumber": (L, "event:pitchNumber"),
        "playId": (S, "play:about.playId"),
        "batterId": (L, "play:matchup.batter.id"),
        "batterName": (S, "play:matchup.batter.fullName"),
        "pitcherId": (L, "play:matchup.pitcher.id"),
        "pitcherName": (S, "play:matchup.pitcher.fullName"),
        "event": (S, "event:details.event"),
        "description": (S, "event:details.description"),
        "pitchType": (S, "event:details.type.code"),
        "releaseSpeed": (D, "event:pitchData.startSpeed"),
        "spinRate": (L, "event:pitchData.breaks.spinRate"),
        "isPitch": (B, "event:isPitch"),
    },
)

LINESCORE = Plan(
    (Step("inning", "payload", "innings"),),
    {
        "gamePk": (L, "@gamePk"),
        "inning": (L, "inning:num"),
        "homeRuns": (L, "inning:home.runs"),
        "homeHits": (L, "inning:home.hits"),
        "homeErrors": (L, "inning:home.errors"),
        "awayRuns": (L, "inning:away.runs"),
        "awayHits": (L, "inning:away.hits"),
        "awayErrors": (L, "inning:away.errors"),
    },
)

PEOPLE = Plan(
    (Step("person", "payload", "people"),),
    {
        **_fields(
            "person",
            {
                "id": L, "fullName": S, "firstName": S, "lastName": S, "primaryNumber": S,
                "birthDate": S, "currentAge": L, "birthCity": S, "birthStateProvince": S,
                "birthCountry": S, "height": S, "weight": L, "active": B,
            },
        ),
        "primaryPositionCode": (S, "person:primaryPosition.code"),
        "primaryPositionName": (S, "person:primaryPosition.name"),
        "primaryPositionAbbrev": (S, "person:primaryPosition.abbreviation"),
        **_fields(
            "person",
            {
                "useName": S, "boxscoreName": S, "gender": S, "isPlayer": B, "isVerified": B,
                "draftYear": L, "mlbDebutDate": S,
            },
        ),
        "batSideCode": (S, "person:batSide.code"),
        "pitchHandCode": (S, "person:pitchHand.code"),
    },
)

AWARDS = Plan(
    (Step("award", "payload", "awards"),),
    {
        "personId": (L, "@personId"),
        "awardId": (S, "award:id"),
        "awardName": (S, "award:name"),
        "date": (S, "award:date"),
        "season": (L, "award:season"),
        "teamId": (L, "award:team.id"),
        "teamName": (S, "award:team.teamName"),
        "positionCode": (S, "award:player.primaryPosition.code"),
        "positionName": (S, "award:player.primaryPosition.name"),
        "positionType": (S, "award:player.primaryPosition.type"),
        "positionAbbreviation": (S, "award:player.primaryPosition.abbreviation"),
    },
)

ROSTER = Plan(
    (Step("entry", "payload", "roster"),),
    {
        "teamId": (L, "@teamId"),
        "personId": (L, "entry:person.id"),
        "fullName": (S, "entry:person.fullName"),
        "jerseyNumber": (S, "entry:jerseyNumber"),
        "positionCode": (S, "entry:position.code"),
        "positionName": (S, "entry:position.name"),
        "positionAbbrev": (S, "entry:position.abbreviation"),
        "positionType": (S, "entry:position.type"),
        "statusCode": (S, "entry:status.code"),
        "statusDesc": (S, "entry:status.description"),
    },
)

_SPLITS = (Step("stats", "payload", "stats"), Step("split", "stats", "splits"))
PLAYER_STATS = Plan(
    _SPLITS,
    {
        "personId": (L, "@personId"),
        "season": (L, "split:season"),
        "group": (S, "stats:group.displayName", "@group"),
        "statType": (S, "stats:type.displayName", "@statType"),
    },
)
TEAM_STATS = Plan(
    _SPLITS,
    {
        "teamId": (L, "@teamId"),
        "season": (L, "split:season"),
        "group": (S, "stats:group.displayName", "@group"),
        "statType": (S, "stats:type.displayName"),
    },
    defaults={"statType": "season"},
)
SPLIT_GROUP = {"": "split:stat"}

STAT_LEADERS = Plan(
    (Step("board", "payload", "leagueLeaders"), Step("entry", "board", "leaders")),
    {
        "rank": (L, "entry:rank"),
        "personId": (L, "entry:person.id"),
        "personName": (S, "entry:person.fullName"),
        "teamId": (L, "entry:team.id"),
        "teamName": (S, "entry:team.name"),
        "leagueId": (L, "entry:league.id"),
        "category": (S, "board:leaderCategory"),
        "value": (D, "entry:value"),
        "season": (L, "@season"),
        "statGroup": (S, "@statGroup"),
    },
    defaults={"category": "unknown"},
)

PITCH_ARSENAL = Plan(
    _SPLITS,
    {
        "personId": (L, "@personId"),
        "season": (L, "@season"),
        "pitchTypeCode": (S, "split:stat.type.code", "split:stat.pitchType.code"),
        "pitchTypeName": (S, "split:stat.type.description", "split:stat.pitchType.description"),
        "percentage": (D, "split:stat.percentage"),
        "averageSpeed": (D, "split:stat.averageSpeed"),
        "statType": (S, "stats:type.displayName"),
    },
    required=("pitchTypeCode", "pitchTypeName", "percentage", "averageSpeed"),
)
# Fixed value: the only kind of split the arsenal reads.
ARSENAL_STAT_TYPE = "pitchArsenal"

DRAFT = Plan(
    (Step("round", "payload", "drafts.rounds"), Step("pick", "round", "picks")),
    {
        "year": (L, "@year"),
        "round": (S, "pick:pickRound", "pick:round"),
        "pickNumber": (L, "pick:pickNumber"),
        "roundPickNumber": (L, "pick:roundPickNumber"),
        "playerName": (S, "pick:person.fullName"),
        "playerId": (L, "pick:person.id"),
        "teamId": (L, "pick:team.id"),
        "teamName": (S, "pick:team.name"),
        "signingBonus": (L, "pick:signingBonus"),
        "homeSchool": (S, "pick:school.name"),
    },
    required=("round", "pickNumber", "playerName"),
)

TRANSACTIONS = Plan(
    (Step("move", "payload", "transactions"),),
    {
        **_fields("move", {"id": L, "date": S, "description": S, "typeCode": S, "typeDesc": S}),
        "playerId": (L, "move:person.id"),
        "playerName": (S, "move:person.fullName"),
        "fromTeamId": (L, "move:fromTeam.id"),
        "fromTeamName": (S, "move:fromTeam.name"),
        "toTeamId": (L, "move:toTeam.id"),
        "toTeamName": (S, "move:toTeam.name"),
    },
    required=("id", "date", "description", "typeCode", "typeDesc"),
)

VENUES = Plan(
    (Step("venue", "payload", "venues"),),
    _fields("venue", {"id": L, "name": S, "link": S, "active": B, "season": S}),
)

TEAMS = Plan(
    (Step("team", "payload", "teams"),),
    {
        **_fields("team", {"id": L, "name": S, "abbreviation": S, "teamName": S, "locationName": S}),
        "leagueId": (L, "team:league.id"),
        "leagueName": (S, "team:league.name"),
        "divisionId": (L, "team:division.id"),
        "divisionName": (S, "team:division.name"),
        "venueId": (L, "team:venue.id"),
        "venueName": (S, "team:venue.name"),
        "springLeague": (S, "team:springLeague.name"),
        "season": (L, "@season"),
    },
)

DIVISIONS = Plan(
    (Step("division", "payload", "divisions"),),
    {
        **_fields("division", {"id": L, "name": S, "nameShort": S, "abbreviation": S, "season": L}),
        "leagueId": (L, "division:league.id"),
        "sportId": (L, "division:sport.id"),
        **_fields("division", {"hasWildcard": B, "sortOrder": L, "numPlayoffTeams": L, "active": B}),
    },
)

LEAGUES = Plan(
    (Step("league", "payload", "leagues"),),
    {
        **_fields(
            "league",
            {
                "id": L, "name": S, "nameShort": S, "abbreviation": S, "orgCode": S, "season": L,
                "seasonState": S, "active": B,
            },
        ),
        "sportId": (L, "league:sport.id"),
        **_fields(
            "league",
            {
                "numTeams": L, "numGames": L, "numWildcardTeams": L, "hasWildCard": B,
                "divisionsInUse": B, "sortOrder": L,
            },
        ),
    },
)

STANDINGS = Plan(
    (Step("record", "payload", "records"), Step("team", "record", "teamRecords")),
    {
        "season": (L, "@season"),
        "division_id": (L, "record:division.id"),
        "division_name": (S, "record:division.name"),
        "teamId": (L, "team:team.id"),
        "Tm": (S, "team:team.name"),
        "W": (L, "team:leagueRecord.wins"),
        "L": (L, "team:leagueRecord.losses"),
        "W-L%": (S, "team:leagueRecord.pct"),
        "GB": (S, "team:gamesBack"),
    },
)

# Gamefeed tables.
EXIT_VELOCITY_TEXT = ("batter_name", "team_batting", "pitcher_name", "team_fielding", "events")
EXIT_VELOCITY_NUMBERS = ("launch_speed", "launch_angle", "hit_distance", "xba", "start_speed")
PITCH_DATA_TEXT = (
    "pitcher_name", "team_pitching", "batter_name", "team_batting", "pitch_name", "pitch_type",
    "description", "events",
)


def schedule(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, SCHEDULE, fail=fail)


def _with_batting_order(rows: DataFrame) -> DataFrame:
    order = clean.batting_order(F.col("battingOrderText"))
    return rows.withColumns({"isInBattingOrder": order.isNotNull(), "battingOrder": order}).drop("battingOrderText")


def boxscore(payloads: DataFrame, fail: bool = True) -> DataFrame:
    """One row per player of both sides."""
    return _with_batting_order(flatten(payloads, BOXSCORE, fail=fail))


def boxscore_stats(payloads: DataFrame) -> DataFrame:
    """Players with the declared batting, pitching and fielding stats as columns."""
    return _with_batting_order(wide_form(payloads, BOXSCORE, BOX_GROUPS, BOX_STATS))


def boxscore_long(payloads: DataFrame) -> DataFrame:
    """Players with every stat the payload has, one row each."""
    return _with_batting_order(long_form(payloads, BOXSCORE, BOX_GROUPS))


def play_by_play(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, PLAY_BY_PLAY, fail=fail)


def win_probability(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, WIN_PROBABILITY, fail=fail)


def live_feed(payloads: DataFrame, fail: bool = True) -> DataFrame:
    """One row per pitch; events that are no pitch are left out."""
    return flatten(payloads, LIVE_FEED, fail=fail).where("isPitch").drop("isPitch")


def linescore(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, LINESCORE, fail=fail)


def people(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, PEOPLE, fail=fail)


def awards(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, AWARDS, fail=fail)


def roster(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, ROSTER, fail=fail)


def player_stats(payloads: DataFrame, stats: dict[str, str] | None = None) -> DataFrame:
    """Long rows, or the declared ``stats`` as columns."""
    if stats is None:
        return long_form(payloads, PLAYER_STATS, SPLIT_GROUP).drop("stat_group")
    return wide_form(payloads, PLAYER_STATS, SPLIT_GROUP, stats)


def team_stats(payloads: DataFrame, stats: dict[str, str] | None = None) -> DataFrame:
    if stats is None:
        return long_form(payloads, TEAM_STATS, SPLIT_GROUP).drop("stat_group")
    return wide_form(payloads, TEAM_STATS, SPLIT_GROUP, stats)


def stat_leaders(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, STAT_LEADERS, fail=fail)


def pitch_arsenal(payloads: DataFrame, fail: bool = True) -> DataFrame:
    """Pitches of a player's arsenal; splits of another kind are left out first."""
    wanted = F.col("statType") == ARSENAL_STAT_TYPE
    return flatten(payloads, PITCH_ARSENAL, fail=fail, only=wanted).drop("statType")


def draft(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, DRAFT, fail=fail)


def transactions(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, TRANSACTIONS, fail=fail)


def venues(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, VENUES, fail=fail)


def teams(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, TEAMS, fail=fail)


def divisions(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, DIVISIONS, fail=fail)


def leagues(payloads: DataFrame, fail: bool = True) -> DataFrame:
    return flatten(payloads, LEAGUES, fail=fail)


def standings(payloads: DataFrame, fail: bool = True) -> DataFrame:
    """Division standings as the provider reports them; unreadable numbers fail the job."""
    rows = flatten(payloads, STANDINGS, fail=fail)
    return rows.withColumns(
        {
            "W-L%": clean.strict_double(ref("W-L%")),
            "GB": clean.strict_double(ref("GB"), clean.GAMES_BACK_NULLS),
        }
    )


def gamefeed_rows(payloads: DataFrame, *nodes: str, body: str = "body", fail: bool = True) -> DataFrame:
    """Objects below nodes that are lists, or objects of lists, with their key.

    The body is parsed once for all nodes. A node of another kind, or an element that is no object,
    fails the job; with ``fail`` off it is left out, and :func:`gamefeed_problems` has its payload.
    """
    found = walk(payloads, (), {ROOT: dict.fromkeys(nodes, "string")}, body)
    keep = refs(c for c in payloads.columns if c != body)
    rows = found.select(*keep, F.explode(F.array(*[ref(f"{ROOT}:{node}") for node in nodes])).alias("_node"))
    listed = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.from_json("_node", LIST).alias("value")))
    mapped = F.map_entries(F.from_json("_node", "map<string,array<string>>"))
    entries = once(rows, _entries=F.when(is_object(F.col("_node")), mapped).otherwise(listed))
    if fail:
        read = F.col("_node").isNull() | F.coalesce(F.forall("_entries", lambda e: e["value"].isNotNull()), F.lit(False))
        entries = entries.where(_or_fail(read, "A gamefeed node is neither a list nor an object of lists: ", "_node"))
    lists = entries.select(*keep, F.inline("_entries"))
    items = lists.select(*keep, F.col("key").alias("item_key"), F.explode("value").alias("item"))
    good = F.coalesce(is_object(F.col("item")), F.lit(False))
    return items.where(_or_fail(good, "A gamefeed element is no object: ", "item") if fail else good)


def gamefeed_objects(
    payloads: DataFrame, node: str, leaves: dict[str, str], body: str = "body", fail: bool = True
) -> DataFrame:
    """Like :func:`gamefeed_rows` of one node, each object parsed into ``parsed_item``.

    A payload is parsed once, objects and all. Where that finds anything unusual (what Spark reports,
    a gap, a text in quotes, as of a number that JSON has no word for), it is read again step by step.
    """
    item = f"struct<{json_schema(leaves, ': ')}>"

    def whole(kind: str) -> Column:
        return F.from_json(ref(body), f"`{node}` {kind}, {REPORT} string", {"columnNameOfCorruptRecord": REPORT})

    # The words only choose what is tried first: a wrong guess is reported.
    keyed = F.rlike(ref(body), F.lit(rf'"{node}"\s*:\s*\{{'))
    as_map, as_list = whole(f"map<string,array<{item}>>"), whole(f"array<{item}>")
    lists = F.when(keyed, _usual(as_map, lambda doc: F.map_values(doc[node]))).otherwise(
        _usual(as_list, lambda doc: F.when(doc[node].isNotNull(), F.array(doc[node])))
    )
    odd = lambda o: o.isNull() | reduce(Column.__or__, [F.coalesce(F.startswith(inside(o, path), F.lit('"')), F.lit(False)) for path in leaves])
    plain = F.forall("_lists", lambda values: values.isNotNull() & ~F.exists(values, odd))
    keep = refs(c for c in payloads.columns if c != body)
    rows = once(payloads, _lists=lists)
    usual = F.coalesce(plain, F.lit(False))
    step_by_step = F.transform(_gamefeed_texts(ref(body), node, fail), lambda text: parsed(text, leaves))
    items = F.when(usual, F.flatten("_lists")).otherwise(step_by_step)
    return once(rows, _items=items).select(*keep, F.explode("_items").alias("parsed_item"))


def _usual(doc: Column, lists) -> Column:
    """Lists of a parsed payload, none if Spark reports something; the payload is parsed once for both."""
    return F.get(F.transform(F.array(doc), lambda d: F.when(d[REPORT].isNull(), lists(d))), F.lit(0))


def _gamefeed_texts(text: Column, node: str, fail: bool) -> Column:
    """Objects below a node of one payload as texts, read as :func:`gamefeed_rows` reads them."""

    def below(value: Column) -> Column:
        mapped = F.map_values(F.from_json(value, "map<string,array<string>>"))
        lists = F.when(is_object(value), mapped).otherwise(F.array(F.from_json(value, LIST)))
        if not fail:
            return lists
        read = value.isNull() | F.coalesce(F.forall(lists, Column.isNotNull), F.lit(False))
        return F.when(_or_raise(read, "A gamefeed node is neither a list nor an object of lists: ", value), lists)

    nodes = F.transform(F.array(parsed(text, {node: "string"})[node]), below)
    texts = F.flatten(F.filter(F.get(nodes, F.lit(0)), Column.isNotNull))
    good = lambda item: F.coalesce(is_object(item), F.lit(False))
    return F.filter(texts, lambda item: _or_raise(good(item), "A gamefeed element is no object: ", item) if fail else good(item))


def _or_fail(good: Column, message: str, value: str) -> Column:
    return _or_raise(good, message, F.col(value))


def _or_raise(good: Column, message: str, value: Column) -> Column:
    shown = F.coalesce(F.left(value, F.lit(100)), F.lit("null"))
    return F.when(good, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(message), shown)).cast("boolean"))


def gamefeed_problems(payloads: DataFrame, node: str, body: str = "body") -> DataFrame:
    """Payloads whose node is neither a list nor an object of lists of objects."""
    rows = walk(payloads, (), {ROOT: {node: "string"}}, body).withColumnRenamed(f"{ROOT}:{node}", "_node")
    mapped = F.map_values(F.from_json("_node", OBJECT))
    lists = F.when(is_object(F.col("_node")), mapped).otherwise(F.array("_node"))
    readable = F.forall(
        lists, lambda v: F.startswith(v, F.lit("[")) & F.forall(F.from_json(v, LIST), lambda i: F.coalesce(is_object(i), F.lit(False)))
    )
    return rows.where(F.col("_node").isNotNull() & ~F.coalesce(readable, F.lit(False))).drop("_node")


def _request(name: str, rows: DataFrame):
    source = ref(name) if name in rows.columns else F.try_element_at(ref("params"), F.lit(name))
    return source.try_cast("bigint")


def exit_velocity(payloads: DataFrame, fail: bool = True) -> DataFrame:
    """Batted balls of any number of games."""
    parks = "contextMetrics.homeRunBallparks"
    leaves = dict.fromkeys((*EXIT_VELOCITY_TEXT, *EXIT_VELOCITY_NUMBERS, parks), "string")
    rows = gamefeed_objects(payloads, "exit_velocity", leaves, fail=fail)
    return rows.select(
        _request("gamePk", rows).alias("game_pk"),
        *[clean.trim_text(field_at("parsed_item", c)).alias(c) for c in EXIT_VELOCITY_TEXT],
        *[clean.lenient_double(field_at("parsed_item", c)).alias(c) for c in EXIT_VELOCITY_NUMBERS],
        clean.lenient_int(field_at("parsed_item", parks)).alias("home_run_ballparks"),
    )


# Where the pitcher of a pitch may be named, and the two break keys.
PITCHER_NODES = ("home_pitchers", "away_pitchers")
PITCHER_KEYS = ("pitcher_id", "pitcher", "player_id")
NESTED_PITCHER_KEYS = ("pitcher", "player")
BREAK_X_KEY = "breakXInches"
BREAK_Z_KEYS = ("breakZInducedInches", "inducedBreakZ")


def pitch_data(payloads: DataFrame, fail: bool = True) -> DataFrame:
    """Pitches of both sides; the pitcher is the map key, a flat ID or a nested one."""
    names = (*PITCH_DATA_TEXT, "start_speed", "spin_rate", BREAK_X_KEY, *BREAK_Z_KEYS, *PITCHER_KEYS, "player")
    items = gamefeed_rows(payloads, *PITCHER_NODES, fail=fail)
    flat = once(items, parsed_item=parsed(F.col("item"), dict.fromkeys(names, "string")))
    nested = [parsed(field_at("parsed_item", key), {"id": "string"})["id"] for key in NESTED_PITCHER_KEYS]
    rows = once(flat, nested_ids=F.array(*nested))
    at = lambda name: field_at("parsed_item", name)
    pitcher = clean.first_present(
        clean.lenient_int(F.col("item_key")),
        *[clean.lenient_int(at(key)) for key in PITCHER_KEYS],
        *[clean.lenient_int(F.get("nested_ids", F.lit(i))) for i in range(len(NESTED_PITCHER_KEYS))],
    )
    columns = {
        "game_pk": _request("gamePk", rows),
        "pitcher_id": pitcher,
        **{c: clean.trim_text(at(c)) for c in PITCH_DATA_TEXT},
        "start_speed": clean.lenient_double(at("start_speed")),
        "spin_rate": clean.lenient_int(at("spin_rate")),
        "break_x_inches": clean.lenient_double(at(BREAK_X_KEY)),
        "break_z_induced_inches": clean.lenient_double(clean.first_present(*[at(key) for key in BREAK_Z_KEYS])),
    }
    read = F.struct(*[value.alias(name) for name, value in columns.items()])
    return once(rows, _read=read).select("_read.*")


def keyword(words: Column, kind: str) -> Column:
    """Value of the first keyword of a type that has one."""
    hits = F.filter(words, lambda k: (k["type"] == kind) & k["value"].isNotNull())
    return F.try_element_at(hits, F.lit(1))["value"]


def highlights(payloads: DataFrame) -> DataFrame:
    """Clips of games that have a playable URL, the one with the highest bitrate."""
    texts = ("id", "mediaPlaybackId", "playId", "headline", "blurb", "duration", "date")
    leaves = {**dict.fromkeys(texts, "string"), "playbacks": LIST, "keywordsAll": LIST}
    step = Step("item", ROOT, "highlights.highlights.items")
    rows = walk(payloads, (step,), {"item": leaves})
    at = lambda path: ref(f"item:{path}")
    urls = F.transform(F.filter(at("playbacks"), is_object), lambda p: parsed(p, {"url": "string"})["url"])
    words = F.transform(
        F.filter(at("keywordsAll"), is_object), lambda k: parsed(k, {"type": "string", "value": "string"})
    )
    fixed = rows.select(
        _request("gamePk", rows).alias("gamePk"), *[at(c).alias(c) for c in texts], urls.alias("_urls"), words.alias("_words")
    )
    none = F.array().cast("array<struct<type:string,value:string>>")
    read = once(fixed, urls=F.col("_urls"), words=F.coalesce("_words", none))
    filled = lambda name: F.nullif(F.col(name), F.lit(""))
    found = read.select(
        "gamePk",
        clean.first_present(filled("id"), filled("mediaPlaybackId")).alias("highlightId"),
        clean.first_present(filled("playId"), keyword(F.col("words"), "play_id")).alias("playId"),
        clean.trim_text(keyword(F.col("words"), "player_id")).try_cast("bigint").alias("playerId"),
        F.col("headline").alias("title"),
        "blurb",
        "duration",
        "date",
        "urls",
    )
    found = once(found, url=best_item(F.col("urls"), clean.url_bitrate)).drop("urls")
    return found.where(F.col("url") != "").withColumn("best_mp4_url", F.col("url"))


def list_or_map(payloads: DataFrame, node: str, columns: dict[str, tuple[str, str]], body: str = "body") -> DataFrame:
    """Rows below a node that may be a list of objects or an object of objects."""
    rows = walk(payloads, (), {ROOT: {node: "string"}}, body)
    keep = refs(c for c in payloads.columns if c != body)
    leaves = {path: "string" for _, path in columns.values()}
    items = rows.select(*keep, F.explode(objects(ref(f"{ROOT}:{node}"))).alias("_text"))
    read = once(items, _item=parsed(F.col("_text"), leaves))
    return read.select(
        *keep, *[field_at("_item", path).try_cast(kind).alias(name) for name, (kind, path) in columns.items()]
    )
