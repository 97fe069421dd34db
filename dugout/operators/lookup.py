"""Player lookup: register, exact and reverse search, fuzzy suggestions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugout.errors import SchemaMismatch
from dugout.functions import clean
from dugout.operators.filters import any_present
from dugout.operators.align import require_rows
from dugout.operators.names import ref, refs
from dugout.operators.typed import add_missing
from dugout.sources import schemas

# What counts as a close name.
CLOSE_ENOUGH = 0.5
SUGGESTIONS = 5

PLAIN_LAST = "name_last_plain"
PLAIN_FIRST = "name_first_plain"


def normalize_register(people: DataFrame) -> DataFrame:
    """The register: people known to any big-league system, absent IDs as -1. A table without columns or rows is an error."""
    if not people.columns:
        raise SchemaMismatch("The people table has no columns.")
    require_rows(people, "The people table has no rows.")
    full = any_present(add_missing(people, schemas.REGISTER), schemas.REGISTER_MLB_COLUMNS)
    numbered = full.withColumns(
        {c: clean.id_or_sentinel(ref(c)) for c in ("key_mlbam", "key_fangraphs")},
    )
    return numbered.select(*refs(schemas.REGISTER))


def lookup_table(register: DataFrame, last: str = "name_last", first: str = "name_first") -> DataFrame:
    """Register with lower-cased names and accent-free copies of them."""
    lowered = register.withColumns({last: F.lower(ref(last)), first: F.lower(ref(first))})
    return lowered.withColumns(
        {PLAIN_LAST: clean.strip_accents(ref(last)), PLAIN_FIRST: clean.strip_accents(ref(first))}
    )


def _query(text: str | None, ignore_accents: bool) -> str | None:
    if text is None:
        return None
    return clean.strip_accents_text(text.lower()) if ignore_accents else text.lower()


def find_player(
    table: DataFrame,
    last: str,
    first: str | None = None,
    ignore_accents: bool = False,
    columns: tuple[str, str] = ("name_last", "name_first"),
) -> DataFrame:
    """Rows with exactly this name, in the original spelling."""
    last_column, first_column = (PLAIN_LAST, PLAIN_FIRST) if ignore_accents else columns
    found = table.where(ref(last_column) == _query(last, ignore_accents))
    if first:
        found = found.where(ref(first_column) == _query(first, ignore_accents))
    return found.drop(PLAIN_LAST, PLAIN_FIRST)


def similarity(wanted: str) -> callable:
    """Column function: similarity of a name to ``wanted``, 0 when below the bar.

    Spark has edit distance but not this measure, so names are scored in Arrow
    batches. Cheap upper bounds come first.
    """

    @F.pandas_udf("double")
    def score(names: pd.Series) -> pd.Series:
        matcher = SequenceMatcher()
        matcher.set_seq2(wanted)
        return names.map(lambda name: close_ratio(matcher, name)).astype("float64")

    return score


def close_ratio(matcher: SequenceMatcher, name: str) -> float:
    matcher.set_seq1(name)
    for bound in (matcher.real_quick_ratio, matcher.quick_ratio, matcher.ratio):
        value = bound()
        if value < CLOSE_ENOUGH:
            return 0.0
    return value


def suggest_players(
    table: DataFrame,
    last: str,
    first: str | None = None,
    ignore_accents: bool = False,
    columns: tuple[str, str] = ("name_last", "name_first"),
    limit: int = SUGGESTIONS,
    tolerance: int | None = None,
) -> DataFrame:
    """Every row bearing one of the ``limit`` closest entries' names.

    All names are scored, however many there are; with ``tolerance`` only those
    whose last name is that much longer or shorter at most. Entries are counted
    one by one, so players sharing a name use up several of the places; ties go
    to the later name. The closest are found by a top-k, and their names select
    the rows.
    """
    last_column, first_column = (PLAIN_LAST, PLAIN_FIRST) if ignore_accents else columns
    wanted = f"{_query(first, ignore_accents) or ''} {_query(last, ignore_accents)}"
    size = len(_query(last, ignore_accents))
    near = table if tolerance is None else table.where(clean.length_near(ref(last_column), size, tolerance))
    named = near.withColumn("_name", clean.full_name(ref(first_column), ref(last_column)))
    # Each spelling is scored once however many rows bear it.
    spellings = named.groupBy("_name").agg(F.count(F.lit(1)).alias("_entries"))
    scored = spellings.withColumn("_score", similarity(wanted)("_name")).where(F.col("_score") >= CLOSE_ENOUGH)
    best = scored.orderBy(F.desc("_score"), F.desc("_name")).limit(limit)
    earlier = Window.orderBy(F.desc("_score"), F.desc("_name")).rowsBetween(Window.unboundedPreceding, -1)
    entries = F.coalesce(F.sum("_entries").over(earlier), F.lit(0))
    chosen = best.withColumn("_used", entries).where(F.col("_used") < limit).select("_name")
    return named.join(chosen, "_name", "left_semi").drop("_name", PLAIN_LAST, PLAIN_FIRST)


def suggest_many(
    table: DataFrame,
    wanted: Sequence[tuple[str, str]],
    columns: tuple[str, str] = ("name_last", "name_first"),
    limit: int = SUGGESTIONS,
    tolerance: int | None = None,
) -> DataFrame:
    """Suggestions for a list of (last, first) names in one pass over the table.

    The list comes from the caller and travels with the task; every distinct
    spelling is compared to it where it lies, and only close pairs leave the
    task. Result: query, candidate spelling, score, and the number of entries
    that bear it.
    """
    last_column, first_column = columns
    queries = [(f"{last}, {first}", f"{first.lower()} {last.lower()}", len(last)) for last, first in wanted]
    spellings = table.groupBy(
        clean.full_name(ref(first_column), ref(last_column)).alias("candidate"),
        F.char_length(ref(last_column)).alias("last_length"),
    ).agg(F.count(F.lit(1)).alias("entries"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matchers = []
        for label, text, size in queries:
            matcher = SequenceMatcher()
            matcher.set_seq2(text)
            matchers.append((label, matcher, size))
        for batch in batches:
            found = []
            for name, length, entries in batch.itertuples(index=False):
                for label, matcher, size in matchers:
                    if tolerance is not None and abs(length - size) > tolerance:
                        continue
                    value = close_ratio(matcher, name)
                    if value >= CLOSE_ENOUGH:
                        found.append((label, name, value, entries))
            yield pd.DataFrame(found, columns=["query", "candidate", "score", "entries"])

    pairs = spellings.mapInPandas(score, "query string, candidate string, score double, entries bigint")
    window = Window.partitionBy("query").orderBy(F.desc("score"), F.desc("candidate"))
    kept = pairs.withColumn("_row", F.row_number().over(window)).where(F.col("_row") <= limit)
    earlier = Window.partitionBy("query").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    used = kept.withColumn("_used", F.coalesce(F.sum("entries").over(earlier), F.lit(0)))
    return used.where(F.col("_used") < limit).drop("_row", "_used")
