"""Fixed code lists and the functions that translate between them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter

# Pitch codes and their names.
PITCHES = (
    ("FF", "4-Seamer"),
    ("CU", "Curveball"),
    ("CH", "Changeup"),
    ("FC", "Cutter"),
    ("EP", "Eephus"),
    ("FO", "Forkball"),
    ("KN", "Knuckleball"),
    ("KC", "Knuckle-curve"),
    ("SC", "Screwball"),
    ("SI", "Sinker"),
    ("SL", "Slider"),
    ("FS", "Splitter"),
    ("FT", "2-Seamer"),
    ("ST", "Sweeper"),
    ("SV", "Slurve"),
    ("SIFT", "Sinker"),
    ("CUKC", "Curveball"),
    ("ALL", "All"),
)

# Field positions, their names and scoring numbers.
POSITIONS = (
    ("IF", "Infield", None),
    ("OF", "Outfield", None),
    ("C", "Catcher", "2"),
    ("1B", "First Base", "3"),
    ("2B", "Second Base", "4"),
    ("3B", "Third Base", "5"),
    ("SS", "Shortstop", "6"),
    ("LF", "Left Field", "7"),
    ("CF", "Center Field", "8"),
    ("RF", "Right Field", "9"),
    ("ALL", "All", None),
)

# Names accepted by the query functions.
ROSTER_TYPES = (
    "active",
    "full",
    "40Man",
    "allTime",
    "coach",
    "nonRoster",
    "springActive",
    "springNonRoster",
    "team",
)
STAT_GROUPS = ("hitting", "pitching", "fielding")
STAT_CATEGORIES = ("bat", "fld", "pit", "rel", "sta")
LEAGUES = ("all", "al", "fl", "nl", "mnl", "nnl", "ecl", "anl", "ewl", "nsl", "nn2", "nal")
MONTHS = {"march_april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september_october": 9}
FIELD_POSITIONS = ("all", "p", "c", "1b", "2b", "ss", "3b", "rf", "cf", "lf", "of", "dh", "np")
ARSENAL_TYPES = ("avg_speed", "n_", "avg_spin")
PLAYER_KEYS = {"mlbam": "bigint", "retro": "string", "bbref": "string", "fangraphs": "bigint"}
FASTBALLS = ("FF", "SI", "FC")

PITCH_CODES = tuple(code for code, _ in PITCHES)


def _first_wins(pairs) -> dict[str, str]:
    table: dict[str, str] = {}
    for key, value in pairs:
        table.setdefault(key, value)
    return table


_PITCH_BY_ANY = _first_wins([(c, c) for c, _ in PITCHES] + [(n.upper(), c) for c, n in PITCHES])
_PITCH_NAME = dict(PITCHES)
_POSITION_BY_ANY = {key: code for code, name, _ in POSITIONS for key in (code, name.upper())}
_POSITION_NUMBER = {code: number for code, _, number in POSITIONS if number}
_POSITION_NAME = {code: name for code, name, _ in POSITIONS}


def pitch_code(pitch: str) -> str:
    """Code of a pitch given by code or name."""
    try:
        return _PITCH_BY_ANY[pitch.upper()]
    except KeyError:
        raise InvalidParameter(f"{pitch} is not a known pitch.") from None


def pitch_name(pitch: str) -> str:
    return _PITCH_NAME[pitch_code(pitch)]


def position_code(position: str | int) -> str:
    """Code of a position given by code, name or scoring number."""
    text = str(position)
    for code, number in _POSITION_NUMBER.items():
        if text == number:
            return code
    try:
        return _POSITION_BY_ANY[text.upper()]
    except KeyError:
        raise InvalidParameter(f"{position} is not a known position.") from None


def position_number(position: str | int) -> str:
    """Scoring number; group codes keep their code and ``ALL`` becomes empty."""
    code = position_code(position)
    return "" if code == "ALL" else _POSITION_NUMBER.get(code, code)


def position_word(position: str | int) -> str:
    code = position_code(position)
    return "" if code == "ALL" else _POSITION_NAME[code].lower()


def choose(value: str, allowed: tuple[str, ...], label: str) -> str:
    """The canonical spelling of ``value``, whatever its case."""
    for name in allowed:
        if name.lower() == value.lower():
            return name
    raise InvalidParameter(f"{label} must be one of: {', '.join(allowed)}.")


def _literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in table.items() for part in pair])


def pitch_code_column(col: Column) -> Column:
    """Pitch code of a text column, null where the pitch is unknown."""
    return F.try_element_at(_literal_map(_PITCH_BY_ANY), F.upper(col))


def position_number_column(col: Column) -> Column:
    numbers = {key: _POSITION_NUMBER.get(code, code) for key, code in _POSITION_BY_ANY.items() if code != "ALL"}
    numbers.update({number: number for number in _POSITION_NUMBER.values()})
    return F.try_element_at(_literal_map(numbers), F.upper(col))
