"""Bringing columns to declared types: strictly, leniently, or by name rule."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.errors import SchemaMismatch
from dugout.functions import clean
from dugout.operators.names import ref, types_of
from dugout.sources import schemas


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Fail while the plan is built when a required column is missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise SchemaMismatch(f"Missing required columns: {', '.join(missing)}")


def strict_table(df: DataFrame, required: Iterable[str], types: dict[str, str]) -> DataFrame:
    """Check required columns, then cast the declared ones; bad values fail the job.

    Columns without a declared type pass through.
    """
    require_columns(df, required)
    return df.select([ref(c).cast(types[c]).alias(c) if c in types else ref(c) for c in df.columns])


def known_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Only the declared columns that are there, in declared order."""
    return df.select([ref(c) for c in types if c in df.columns])


def canonical_table(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lenient casts of declared columns, typed nulls for absent ones, extras as they are.

    A table without any column is returned unchanged.
    """
    if not df.columns:
        return df
    have = types_of(df)
    present = [_lenient(c, have[c], types[c]) if c in types else ref(c) for c in df.columns]
    absent = [F.lit(None).cast(kind).alias(c) for c, kind in types.items() if c not in have]
    return df.select(present + absent)


def _lenient(name: str, have: str, want: str) -> Column:
    return ref(name) if have == want else ref(name).try_cast(want).alias(name)


def lenient_casts(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lenient casts of the declared columns that are there; nothing is added."""
    have = types_of(df)
    return df.select([_lenient(c, have[c], types[c]) if c in types else ref(c) for c in df.columns])


def add_missing(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed nulls for absent columns; columns already there keep their type."""
    return df.select(
        [ref(c) for c in df.columns]
        + [F.lit(None).cast(kind).alias(c) for c, kind in types.items() if c not in df.columns]
    )


def trim_table(df: DataFrame) -> DataFrame:
    """Column names and text values without surrounding space."""
    named = df.toDF(*[c.strip() for c in df.columns])
    return map_text(named, clean.trim_text)


def map_text(df: DataFrame, function) -> DataFrame:
    """Apply a column function to every text column."""
    return df.select(
        [
            function(ref(field.name)).alias(field.name) if field.dataType.simpleString() == "string" else ref(field.name)
            for field in df.schema.fields
        ]
    )


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def drop_named_like(df: DataFrame, fragments: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in df.columns if any(f in c for f in fragments)])


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([ref(c).alias(prefix + c) for c in df.columns])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value at all.

    The columns of a plan are fixed before it runs, so this runs one aggregate
    that returns a single row of counts.
    """
    if not df.columns:
        return df
    counts = df.agg(*[F.count(ref(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.drop(*[ref(c) for i, c in enumerate(df.columns) if counts[i] == 0])


def with_singles(df: DataFrame) -> DataFrame:
    """Add ``1B`` = hits that were no extra-base hit, where all four counts exist."""
    if not {"H", "2B", "3B", "HR"} <= set(df.columns):
        return df
    return df.withColumn("1B", ref("H") - ref("2B") - ref("3B") - ref("HR"))


@cache
def _stat_patterns() -> tuple[tuple[re.Pattern, str], ...]:
    """Name patterns and their types, in the order they are tried.

    A stat may carry a prefix up to the last underscore. Counts that other tables
    use under the same short name need a prefix with one of the guard words.
    """
    kinds = (("string", schemas.STAT_TEXT), ("bigint", schemas.STAT_INTEGERS), ("double", schemas.STAT_DOUBLES))
    either = lambda names: "|".join(map(re.escape, sorted(names)))
    plain = [(f"(?:{either(names)})", kind) for kind, names in kinds]
    guarded = [(f".*(?i:{either(schemas.STAT_GUARD_WORDS)}).*_(?:{either(found)})", kind) for kind, names in kinds if (found := set(names) & set(schemas.STAT_GUARDED_SUFFIXES))]
    prefixed = [(f".*_(?:{either(found)})", kind) for kind, names in kinds if (found := set(names) - set(schemas.STAT_GUARDED_SUFFIXES))]
    return tuple((re.compile(pattern, re.S), kind) for pattern, kind in (*plain, *guarded, *prefixed))


def stat_type(name: str) -> str | None:
    """Type of a stat-table column by its name, none for names without a rule."""
    return next((kind for pattern, kind in _stat_patterns() if pattern.fullmatch(name)), None)


def coerced(col: Column, have: str, want: str) -> Column:
    """Lenient cast that also reads percent and thousands text."""
    if have == "string" and want == "double":
        return clean.percent_fraction(col)
    if have == "string" and want == "bigint":
        return clean.thousands_int(col)
    return col if have == want else col.try_cast(want)


def stat_rules(df: DataFrame) -> dict[str, str]:
    """The columns a name rule gives a type to, without those left alone."""
    rules = {c: stat_type(c) for c in df.columns if c not in schemas.STAT_LEFT_ALONE}
    return {c: kind for c, kind in rules.items() if kind is not None}


def cast_audit(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """One row per declared column: values, and values the cast would lose.

    All columns are counted in a single pass; the counts are then turned into
    rows, so nothing but one row of numbers is ever shuffled.
    """
    have = types_of(df)
    names = [c for c in types if c in have]
    totals = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(ref(c)).alias("n_values"),
                F.count_if(ref(c).isNotNull() & coerced(ref(c), have[c], types[c]).isNull()).alias("n_lost"),
            ).alias(f"a{i}")
            for i, c in enumerate(names)
        ]
    )
    return totals.select(F.inline(F.array(*[F.col(f"a{i}") for i in range(len(names))])))


def coerce_stats(df: DataFrame, null_words: bool = True) -> DataFrame:
    """Null tokens, then name-rule types; a value the cast would lose fails the job.

    The check sits in the projection, so it costs no second pass.
    """
    source = map_text(df, clean.null_tokens) if null_words else df
    have, rules = types_of(source), stat_rules(source)

    def checked(name: str) -> Column:
        value = coerced(ref(name), have[name], rules[name])
        lost = ref(name).isNotNull() & value.isNull()
        message = F.concat(F.lit(f"failed strict cast: Column '{name}' holds "), ref(name).cast("string"))
        return F.when(lost, F.raise_error(message).cast(rules[name])).otherwise(value).alias(name)

    return source.select([checked(c) if c in rules else ref(c) for c in source.columns])
