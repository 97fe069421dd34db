"""Season-stat columns by name, alias, group or all of them, resolved to a projection or a request text.

A provider numbers its columns; names in order are enough to say all numbers. The common
columns (name, team, season and, for fielders, position) are asked for by one word.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from dugout.errors import InvalidParameter
from dugout.operators.names import ref

# Words for the common columns, a line break and all columns, and their codes.
COMMON, LINE_BREAK, ALL = "COMMON", "LINE_BREAK", "ALL"
COMMON_CODE, LINE_BREAK_CODE = "c", "-1"


@dataclass(frozen=True)
class StatColumns:
    """The columns of one kind of season stats.

    ``names`` are numbered from 0; ``common`` of them are folded into one word. ``aliases`` are
    further words for a name, ``groups`` words for several.
    """

    names: tuple[str, ...]
    common: tuple[str, ...]
    aliases: dict[str, str] = field(default_factory=dict)
    groups: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def extended(self, names: Iterable[str] = (), aliases: dict[str, str] | None = None, groups: dict[str, tuple[str, ...]] | None = None) -> StatColumns:
        """With further columns, numbered on, and further words."""
        return replace(
            self, names=(*self.names, *names), aliases={**self.aliases, **(aliases or {})}, groups={**self.groups, **(groups or {})}
        )

    def resolve(self, values: str | Sequence[str]) -> list[str]:
        """Column names for one word or several, in any case; a word nobody knows is an error.

        ``ALL`` anywhere stands for the common columns, the line break and all others by number.
        """
        words = [values] if isinstance(values, str) else list(values)
        words = [w.strip().upper() for w in words if w is not None and w.strip()]
        if ALL in words:
            return [COMMON, LINE_BREAK, *(n for n in self.names if n not in self.common)]
        return [name for word in words for name in self._word(word)]

    def _word(self, word: str) -> tuple[str, ...]:
        if word in self.groups:
            return tuple(name for inner in self.groups[word] for name in self._word(inner.upper()))
        name = self.aliases.get(word, word)
        if name not in self.names and name not in (COMMON, LINE_BREAK):
            raise InvalidParameter(f"{word} is not a known stat column.")
        return (name,)

    def folded(self, values: str | Sequence[str]) -> list[str]:
        """Names with all common columns as one word in front; nothing for no words."""
        names = self.resolve(values)
        return [COMMON, *(n for n in names if n not in self.common and n != COMMON)] if names else []

    def request_text(self, values: str | Sequence[str]) -> str:
        """The codes of a request, in the provider's spelling."""
        codes = {COMMON: COMMON_CODE, LINE_BREAK: LINE_BREAK_CODE, **{n: str(i) for i, n in enumerate(self.names)}}
        return ",".join(codes[name] for name in self.folded(values))

    def project(self, stats: DataFrame, values: str | Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
        """The common columns that the table has, ``keep``, and the columns of the words, each once.

        Columns are found by name in any case and keep the table's spelling; one that the table
        lacks is an error. No words mean all columns.
        """
        have = {c.upper(): c for c in stats.columns}
        names = self.folded(values) or list(have)
        wanted = [*keep, *(have[c] for c in self.common if c in have)]
        for name in names:
            if name not in (COMMON, LINE_BREAK):
                if name not in have:
                    raise InvalidParameter(f"The table has no column {name}.")
                wanted.append(have[name])
        return stats.select(*[ref(c) for c in dict.fromkeys(wanted)])


# Column names in the order of their codes, and other words for them.
_SHARED = ("NAME", "TEAM", "SEASON")
BATTING = StatColumns(
    names=(
        *_SHARED, "AGE", "G", "AB", "PA", "H", "SINGLES", "DOUBLES", "TRIPLES", "HR", "R", "RBI", "BB", "IBB", "SO", "HBP", "SF", "SH", "GDP",
        "SB", "CS", "AVG", "GB", "FB", "LD", "IFFB", "PITCHES", "BALLS", "STRIKES", "IFH", "BU", "BUH", "BB_PCT", "K_PCT", "BB_K", "OBP", "SLG",
        "OPS", "ISO", "BABIP", "GB_FB", "LD_PCT", "GB_PCT", "FB_PCT", "IFFB_PCT", "HR_FB", "IFH_PCT", "BUH_PCT", "WOBA", "WRAA", "WRC",
        "BATTING", "FIELDING", "REPLACEMENT", "POSITIONAL", "RAR", "WAR", "DOLLARS", "SPD", "WRC_PLUS", "WPA", "NEGATIVE_WPA", "POSITIVE_WPA",
        "RE24", "REW", "PLI", "PHLI", "PH", "WPA_LI", "CLUTCH",
    ),
    common=_SHARED,
    aliases={
        "GAMES": "G", "AT_BATS": "AB", "PLATE_APPEARANCES": "PA", "HITS": "H", "HOME_RUNS": "HR", "RUNS": "R", "WALKS": "BB",
        "INTENTIONAL_WALKS": "IBB", "STRIKE_OUTS": "SO", "HIT_BY_PITCH": "HBP", "SACRIFICE_FLY": "SF", "SACRIFICE_HIT": "SH",
        "GROUNDED_DOUBLE_PLAY": "GDP", "STOLEN_BASES": "SB", "CAUGHT_STEALING": "CS", "BATTING_AVERAGE": "AVG", "GROUND_BALLS": "GB",
        "FLY_BALLS": "FB", "WALK_PERCENTAGE": "BB_PCT", "STRIKE_PERCENTAGE": "K_PCT", "ON_BASE_PERCENTAGE": "OBP", "SLUGGING": "SLG",
        "ON_BASE_PLUS_SLUGGING": "OPS", "ISOLATED_POWER": "ISO", "WEIGHTED_ON_BASE_AVERAGE": "WOBA", "WEIGHTED_RUNS_CREATED": "WRC",
        "BAT": "BATTING", "FLD": "FIELDING", "REP": "REPLACEMENT", "POS": "POSITIONAL", "RUNS_ABOVE_REPLACEMENT": "RAR",
        "WINS_ABOVE_REPLACEMENT": "WAR", "DOL": "DOLLARS", "DOLLARS_VALUE": "DOLLARS", "WEIGHTED_RUNS_CREATED_PLUS": "WRC_PLUS",
        "WIN_PROBABILITY_ADDED": "WPA",
    },
    groups={"SLASH_LINE": ("AVG", "OBP", "SLG")},
)
PITCHING = StatColumns(
    names=(
        *_SHARED, "AGE", "W", "L", "ERA", "G", "GS", "CG", "SHO", "SV", "BS", "IP", "TBF", "H", "R", "ER", "HR", "BB", "IBB", "HBP", "WP", "BK",
        "SO", "GB", "FB", "LD", "IFFB", "BALLS", "STRIKES", "PITCHES", "RS", "IFH", "BU", "BUH", "K_9", "BB_9", "K_BB", "H_9", "HR_9", "AVG",
        "WHIP", "BABIP", "LOB_PCT", "FIP", "GB_FB", "LD_PCT", "GB_PCT", "FB_PCT", "IFFB_PCT", "HR_FB", "IFH_PCT", "BUH_PCT", "STARTING",
        "START_IP", "RELIEVING", "RELIEF_IP", "RAR", "WAR", "DOLLARS", "TERA", "XFIP", "WPA", "NEGATIVE_WPA",
    ),
    common=_SHARED,
    aliases={
        "WINS": "W", "LOSSES": "L", "GAMES": "G", "COMPLETE_GAMES": "CG", "SHUT_OUTS": "SHO", "SAVES": "SV", "INNINGS_PITCHED": "IP",
        "HITS": "H", "RUNS": "R", "EARNED_RUNS": "ER", "HOME_RUNS": "HR", "WALKS": "BB", "INTENTIONAL_WALKS": "IBB", "HIT_BY_PITCH": "HBP",
        "WILD_PITCHES": "WP", "BALKS": "BK", "STRIKE_OUTS": "SO", "GROUND_BALLS": "GB", "FLY_BALLS": "FB",
        "LEFT_ON_BASE_PERCENTAGE": "LOB_PCT", "FIELDING_INDEPENDENT_PITCHING": "FIP", "RUNS_ABOVE_REPLACEMENT": "RAR",
        "WINS_ABOVE_REPLACEMENT": "WAR", "DOLLARS_VALUE": "DOLLARS", "EXPECTED_FIELDING_INDEPENDENT_PITCHING": "XFIP",
        "WIN_PROBABILITY_ADDED": "WPA", "NEGATIVE_WIN_PROBABILITY_ADDED": "NEGATIVE_WPA",
    },
)
FIELDING = StatColumns(
    names=(
        *_SHARED, "POS", "G", "GS", "INN", "PO", "A", "E", "FE", "TE", "DP", "DPS", "DPT", "DPF", "SCP", "SB", "CS", "PB", "WP", "FP", "TZ",
        "RSB", "RGDP", "RARM", "RGFP", "RPM", "DRS", "BIZ", "PLAYS", "RZR", "OOZ", "TZL", "FSR", "ARM", "DPR", "RNGR", "ERRR", "UZR", "UZR_150",
        "CPP", "RPP", "DEF",
    ),
    common=(*_SHARED, "POS"),
    aliases={
        "POSITION": "POS", "GAMES": "G", "GAMES_STARTED": "GS", "INNINGS": "INN", "PUT_OUTS": "PO", "ASSISTS": "A", "ERRORS": "E",
        "FORCED_ERRORS": "FE", "FIELDING_PCT": "FP", "ULTIMATE_ZONE_RATING": "UZR", "ULTIMATE_ZONE_RATING_PER_150": "UZR_150",
    },
)
BY_CATEGORY = {"bat": BATTING, "fld": FIELDING, "pit": PITCHING, "rel": PITCHING, "sta": PITCHING}


def stat_columns(category: str) -> StatColumns:
    """The columns of a stat category; relievers and starters have those of pitchers."""
    if category not in BY_CATEGORY:
        raise InvalidParameter(f"{category} is not one of {', '.join(BY_CATEGORY)}.")
    return BY_CATEGORY[category]
