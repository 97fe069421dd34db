"""Unions of tables whose columns or types differ.

Spark would widen STRING and DOUBLE to DOUBLE and then fail on text, so the
target type of every shared column is fixed on the driver, from schemas alone,
and each side is cast before the union.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter, PayloadRejected, SchemaMismatch
from dugout.operators.names import ref, types_of
from dugout.sources import schemas

Policy = Callable[[str, set[str]], str]

_FLOATS = {"float", "double"}
_INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def _numeric(kind: str) -> bool:
    return kind in _FLOATS | _INTEGERS or kind.startswith("decimal")


def pitch_policy(name: str, kinds: set[str]) -> str:
    """Declared type if any; numbers win over text; fractions win over integers."""
    if name in schemas.CSV_OVERRIDES:
        return schemas.CSV_OVERRIDES[name]
    numbers = {kind for kind in kinds if _numeric(kind)}
    if not numbers:
        return "string"
    if "string" in kinds or numbers - _INTEGERS:
        return "double"
    return "bigint"


def prospect_policy(name: str, kinds: set[str]) -> str:
    """Text wins; otherwise a double among the types; otherwise text."""
    if "string" in kinds or "double" not in kinds:
        return "string"
    return "double"


def conflicts(frames: Iterable[DataFrame], policy: Policy) -> dict[str, str]:
    """Target types of the columns that come with more than one type."""
    seen: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in types_of(frame).items():
            seen.setdefault(name, set()).add(kind)
    return {name: policy(name, kinds) for name, kinds in seen.items() if len(kinds) > 1}


def diagonal_union(*frames: DataFrame, policy: Policy = pitch_policy) -> DataFrame:
    """All rows and all columns of all tables; absent cells are null."""
    used = [frame for frame in frames if frame.columns]
    targets = conflicts(used, policy)
    aligned = [
        frame.select([ref(c).try_cast(targets[c]).alias(c) if c in targets else ref(c) for c in frame.columns])
        for frame in used
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def vertical_union(*frames: DataFrame) -> DataFrame:
    """All rows of tables that share one schema."""
    first = types_of(frames[0])
    for frame in frames[1:]:
        if types_of(frame) != first:
            raise SchemaMismatch("Vertical union needs tables with the same columns and types.")
    return reduce(DataFrame.unionByName, frames)


def first_source(df: DataFrame, keys: list[str], priority: str) -> DataFrame:
    """Per key, the rows of the source with the lowest priority number.

    The minimum is aggregated map-side and joined back, so a key that owns a
    large part of the rows is never gathered into one sorted window.
    """
    best = df.groupBy(*keys).agg(F.min(priority).alias("_best"))
    same = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]
    same.append(F.col(f"l.`{priority}`") == F.col("r._best"))
    return df.alias("l").join(best.alias("r"), same, "left_semi")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when a table is empty; looks for one row only."""
    if df.isEmpty():
        raise PayloadRejected(message)
    return df


def pick_table(tables: DataFrame, player_type: str | None, index: str = "table_index") -> DataFrame:
    """Rows of one extracted table: batters the first, pitchers the second, none all. A table that no page has is an error."""
    if player_type is None:
        return tables
    positions = {"batters": 0, "pitchers": 1}
    if player_type not in positions:
        raise InvalidParameter(f"player_type must be one of: {', '.join(positions)}.")
    return require_rows(tables.where(F.col(index) == positions[player_type]), f"No page has a table of {player_type}.")
