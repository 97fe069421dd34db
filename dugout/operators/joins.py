"""Joins. No side is ever forced to be broadcast.

Spark broadcasts a side when its size is known to be below
``spark.sql.autoBroadcastJoinThreshold``, from file statistics or at run time,
and otherwise sorts and merges, splitting skewed partitions. A dimension that
outgrows the threshold therefore changes the plan, not the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter
from dugout.functions import clean, codes
from dugout.operators.filters import all_of
from dugout.operators.names import ref
from dugout.operators.typed import prefixed


def attach(df: DataFrame, dimension: DataFrame, on: dict[str, str], how: str = "left") -> DataFrame:
    """Add the columns of a dimension; ``on`` maps table columns to its keys."""
    pairs = [df[f"`{a}`"] == dimension[f"`{b}`"] for a, b in on.items()]
    return df.join(dimension, all_of(pairs), how)


def prefixed_join(df: DataFrame, other: DataFrame, prefix: str, on: dict[str, str]) -> DataFrame:
    """Inner join after prefixing every column of the other table."""
    renamed = prefixed(other, prefix)
    return attach(df, renamed, {a: prefix + b for a, b in on.items()}, "inner")


def matching(df: DataFrame, keys: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows with a partner in ``keys``; repeated keys do not repeat rows."""
    pairs = [df[f"`{a}`"] == keys[f"`{b}`"] for a, b in on.items()]
    return df.join(keys, all_of(pairs), "left_semi")


def by_names(df: DataFrame, names: Sequence[tuple[str, str]], last: str = "name_last", first: str = "name_first") -> DataFrame:
    """Rows whose (last, first) name is in a list given by the caller."""
    wanted = [f"{a.lower()}|{b.lower()}" for a, b in names]
    return df.where(F.concat(ref(last), F.lit("|"), ref(first)).isin(wanted))


def by_ids(df: DataFrame, ids: Sequence, key: str = "mlbam", column: str | None = None) -> DataFrame:
    """Rows whose key in the chosen system is in a list given by the caller."""
    if key not in codes.PLAYER_KEYS:
        raise InvalidParameter(f"key must be one of: {', '.join(codes.PLAYER_KEYS)}.")
    try:
        wanted = [int(i) if codes.PLAYER_KEYS[key] == "bigint" else str(i) for i in ids]
    except ValueError as problem:
        raise InvalidParameter(f"Invalid integer player ID for {key}: {problem}") from None
    return df.where(ref(column or f"key_{key}").isin(wanted))


def with_player_keys(df: DataFrame, register: DataFrame, player: str, key: str = "key_mlbam") -> DataFrame:
    """Other systems' IDs for a player column; placeholder IDs match nobody."""
    real = register.where(ref(key) != clean.MISSING_ID)
    return attach(df, real, {player: key}, "left")


def by_name_key(df: DataFrame, dimension: DataFrame, name: str, dimension_name: str, how: str = "inner") -> DataFrame:
    """Join display names that differ only in case, spaces and hyphens."""
    keyed = df.withColumn("_key", clean.name_key(ref(name)))
    other = dimension.withColumn("_other_key", clean.name_key(ref(dimension_name)))
    return keyed.join(other, F.col("_key") == F.col("_other_key"), how).drop("_key", "_other_key")


def key_by_name(dimension: DataFrame, wanted: str, name: str, key: str) -> int:
    """The key of the row whose name is the given one but for case, spaces and hyphens.

    No such row, several keys, or a placeholder for a key is an error.
    """
    hits = dimension.where(clean.name_key(ref(name)) == clean.name_key(F.lit(wanted))).select(ref(key)).distinct().limit(2).collect()
    if len(hits) != 1 or hits[0][0] is None or hits[0][0] == clean.MISSING_ID:
        raise InvalidParameter(f"{wanted!r} is not the name of exactly one row with a {key}.")
    return hits[0][0]


def follow(
    df: DataFrame,
    entities: DataFrame,
    pointer: Column,
    fields: dict[str, Column],
    scope: Sequence[str] = ("payload_id",),
) -> DataFrame:
    """Resolve a pointer inside its payload and add fields of the entity it names.

    ``entities`` holds ``scope`` columns, ``ref`` and ``value``. A
    pointer without a target leaves the new fields null.
    """
    side = entities.select(
        *[ref(c).alias(f"_e_{c}") for c in scope],
        F.col("ref").alias("_e_ref"),
        *[expression.alias(name) for name, expression in fields.items()],
    )
    same = [ref(c) == F.col(f"_e_{c}") for c in scope] + [F.col("_pointer") == F.col("_e_ref")]
    joined = df.withColumn("_pointer", pointer).join(side, all_of(same), "left")
    return joined.drop("_pointer", "_e_ref", *[f"_e_{c}" for c in scope])
