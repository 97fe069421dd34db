"""Predicates: the stat-filter language, clip search and the named row filters."""

from __future__ import annotations

import operator
import re
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dugout.errors import InvalidParameter
from dugout.functions import clean, codes
from dugout.operators.names import ref
from dugout.operators.seasons import current_season
from dugout.sources import schemas

#: Signs a rule may use, by the short names they are written with.
SIGNS = {"gt": ">", "gte": ">=", "lt": "<", "lte": "<=", "eq": "=", "ne": "!="}


class Rule(NamedTuple):
    """A column compared with a value. Rows with a null never match."""

    column: str
    sign: str
    value: int | float | str


def rule(column: str, sign: str, value: int | float | str) -> Rule:
    """A rule; the sign as a symbol or a short name, in any case."""
    known = {**SIGNS, **{symbol: symbol for symbol in SIGNS.values()}, "==": "="}
    symbol = known.get(sign.strip().lower())
    if symbol is None:
        raise InvalidParameter(f"No comparison is called {sign!r}; there are {', '.join(known)}.")
    return Rule(column, symbol, value)


def _rule_column(df: DataFrame, column: str, sign: str, value) -> Column:
    """The rule as a predicate; Spark casts the value to the column's type, so no digit is lost.

    Number text with a zero fraction fits a whole-number column; text that is no
    value of the column's type is refused.
    """
    if column not in df.columns:
        raise InvalidParameter(f"Filter column {column!r} is not in the table.")
    kind = df.schema[column].dataType
    literal = F.lit(value)
    if isinstance(value, str) and isinstance(kind, T.NumericType):
        text = re.sub(r"^([+-]?[0-9]+)\.0*$", r"\1", value.strip())
        wanted = kind
        if isinstance(kind, T.IntegralType) and not re.fullmatch(r"[+-]?[0-9]+", text):
            wanted = T.DecimalType(38, 10)  # a bound between two whole numbers
        literal = F.lit(text).cast(wanted)
        if df.sparkSession.range(1).select(F.lit(text).try_cast(wanted).isNull()).first()[0]:
            raise InvalidParameter(f"{value!r} is no {kind.simpleString()}, the type of {column}.")
    by_sign = {">": ref(column) > literal, ">=": ref(column) >= literal, "<": ref(column) < literal, "<=": ref(column) <= literal}
    by_sign |= {"=": ref(column) == literal, "!=": ref(column) != literal}
    return by_sign[sign]


def stat_filter(df: DataFrame, rules: Iterable[tuple]) -> DataFrame:
    """Rows for which every (column, sign, value) holds; one conjunction, so it reaches the scan."""
    wanted = [_rule_column(df, *rule(*given)) for given in rules]
    return df.where(all_of(wanted)) if wanted else df


def format_filters(rules: Iterable[tuple]) -> str:
    """Rules as ``column,name,value|column,name,value``."""
    names = {symbol: name for name, symbol in SIGNS.items()}
    return "|".join(f"{r.column},{names[r.sign]},{r.value}" for r in (rule(*given) for given in rules))


def parse_filters(text: str) -> list[Rule]:
    """Rules of a text that ``format_filters`` writes; values stay text."""
    parts = [part.split(",", 2) for part in text.split("|") if part]
    if any(len(part) != 3 for part in parts):
        raise InvalidParameter(f"{text!r} is not made of column,comparison,value.")
    return [rule(*part) for part in parts]


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(operator.and_, predicates) if predicates else F.lit(True)


def any_of(predicates: Sequence[Column]) -> Column:
    return reduce(operator.or_, predicates)


def any_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in at least one of the columns."""
    return df.where(any_of([ref(c).isNotNull() for c in columns]))


def named_players(
    df: DataFrame,
    name: str = "player_name",
    player_id: str | None = "player_id",
    placeholder: int = schemas.PLACEHOLDER_PLAYER,
) -> DataFrame:
    """Rows with a name and, where an ID column is given, a real player."""
    named = df.where(clean.trim_text(ref(name)) != "")
    return named if player_id is None else named.where(ref(player_id) != placeholder)


def at_venues(df: DataFrame, venues: Sequence[int] | None, column: str = "venue_id") -> DataFrame:
    """Rows of the given venues; always only venues with a positive number."""
    valid = df.where(ref(column) > 0)
    if venues is None:
        return valid
    if any(isinstance(v, bool) or not isinstance(v, int) or v <= 0 for v in venues):
        raise InvalidParameter("Venue IDs must be positive integers.")
    return valid.where(ref(column).isin(list(venues)))


def draft_round(df: DataFrame, number: int | None = None, team: int | None = None) -> DataFrame:
    """Picks of one numbered round; lettered rounds never match a number."""
    picks = df if number is None else df.where(ref("round").try_cast("bigint") == number)
    return picks if team is None else picks.where(ref("teamId") == team)


def team_seasons(df: DataFrame, season: int | None = None, league: str = "ALL") -> DataFrame:
    rows = df if season is None else df.where(ref("yearID") == season)
    return rows if league.upper() == "ALL" else rows.where(ref("lgID") == league.upper())


def without_header_rows(df: DataFrame, column: str, header: str) -> DataFrame:
    """Rows whose cell is not the repeated header; empty cells go too."""
    return df.where(ref(column) != header)


def located(df: DataFrame, columns: Sequence[str] = ("hc_x", "hc_y")) -> DataFrame:
    """Rows with every coordinate present."""
    return df.dropna(subset=list(columns))


def positioned(df: DataFrame, position: str | int, column: str = "pos") -> DataFrame:
    """Rows of one fielding position; ``ALL``, groups and the catcher are refused."""
    code = codes.position_code(position)
    number = codes.position_number(code)
    if code in ("IF", "OF", "C") or number == "":
        raise InvalidParameter(f"{position} is not a single fielding position of this board.")
    return df.where(codes.position_number_column(ref(column).cast("string")) == number)


def year_list(years=None, first: int = 2015, start: int | None = None, end: int | None = None) -> list[int]:
    """Years of an int, a list, an inclusive (start, end) tuple or a start and an end; none is the current season.

    A start and an end come together and go before ``years``.
    """
    if start is not None or end is not None:
        if not isinstance(start, int) or not isinstance(end, int):
            raise InvalidParameter("A start and an end year must be given together.")
        years = (start, end)
    if years is None:
        found = [current_season()]
    elif isinstance(years, int):
        found = [years]
    elif isinstance(years, tuple) and len(years) == 2:
        if years[0] > years[1]:
            raise InvalidParameter(f"The first year of {years} is after the last.")
        found = list(range(years[0], years[1] + 1))
    else:
        found = list(years)
    if not found or any(isinstance(y, bool) or not isinstance(y, int) or y < first for y in found):
        raise InvalidParameter(f"Years must be integers from {first} on.")
    return found


def scheduled(
    games: DataFrame,
    season: int | None = None,
    date: str | None = None,
    team: int | None = None,
    postseason: bool = False,
) -> DataFrame:
    """Games of a season or of a day, of one team if asked."""
    if (season is None) == (date is None):
        raise InvalidParameter("Give either a season or a date.")
    wanted = [ref("season") == str(season) if date is None else ref("officialDate") == date]
    if team is not None:
        wanted.append((ref("homeTeamId") == team) | (ref("awayTeamId") == team))
    if postseason:
        wanted.append(ref("gameType") == "P")
    return games.where(all_of(wanted))


def moves(
    df: DataFrame, date: str | None = None, start: str | None = None, end: str | None = None, sport: int | None = None
) -> DataFrame:
    """Transactions of a day or of a range, of one sport if asked."""
    ranged = start is not None or end is not None
    if ranged == (date is not None) or (ranged and None in (start, end)):
        raise InvalidParameter("Give either a date or a start and an end.")
    found = df.where(ref("date").between(start, end) if ranged else ref("date") == date)
    return found if sport is None else found.where(ref("sportId") == sport)


def roster(df: DataFrame, team: int, season: int, roster_type: str = "active") -> DataFrame:
    kind = codes.choose(roster_type, codes.ROSTER_TYPES, "roster_type")
    return df.where((ref("teamId") == team) & (ref("season") == season) & (ref("rosterType") == kind))


# What a clip search that asks for nothing finds.
DEFAULT_CLIPS = {"event_type": ("Home Run",)}


def find_clips(clips: DataFrame, members: dict | None = None, bounds: dict | None = None, **options) -> DataFrame:
    """Clip search on the clip table; without any condition it finds home runs."""
    asked = any((members or {}).values()) or any(pair != (None, None) for pair in (bounds or {}).values())
    return clip_search(clips, members if asked else DEFAULT_CLIPS, bounds, **options)


def clip_search(
    clips: DataFrame,
    members: dict[str, Sequence] | None = None,
    bounds: dict[str, tuple] | None = None,
    newest: Sequence[str] = ("date",),
    limit: int | None = None,
    page: int = 1,
) -> DataFrame:
    """Rows in every given value list and within every bound, newest first.

    ``members`` maps a column to its accepted values, ``bounds`` to a (low,
    high) pair where either end may be None. With ``limit`` only that page is
    kept: a top-k, never a full sort.
    """
    wanted = [ref(c).isin(list(values)) for c, values in (members or {}).items() if values]
    for column, (low, high) in (bounds or {}).items():
        if low is not None and high is not None and low > high:
            raise InvalidParameter(f"The lower bound of {column} exceeds the upper one.")
        if low is not None:
            wanted.append(ref(column) >= F.lit(low))
        if high is not None:
            wanted.append(ref(column) <= F.lit(high))
    ordered = clips.where(all_of(wanted)).orderBy(*[ref(c).desc_nulls_last() for c in newest])
    if limit is None:
        return ordered
    return ordered.offset((page - 1) * limit).limit(limit) if page > 1 else ordered.limit(limit)
