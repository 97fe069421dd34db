"""Season calendar: date arguments, chunks, and the in-season predicate."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter
from dugout.sources import schemas


def as_date(value: str | date | None) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    try:
        return datetime.strptime(value or "", "%Y-%m-%d").date()
    except (TypeError, ValueError):
        raise InvalidParameter("Incorrect data format, should be YYYY-MM-DD") from None


def date_range(start: str | date | None, end: str | date | None, today: date | None = None) -> tuple[date, date]:
    """Both bounds as dates in order; a missing one copies the other, none means yesterday on."""
    today = today or date.today()
    if start is None and end is None:
        return today - timedelta(days=1), today
    low, high = as_date(start if start is not None else end), as_date(end if end is not None else start)
    return min(low, high), max(low, high)


def current_season(today: date | None = None) -> int:
    """The season under way, which starts on March 15."""
    today = today or date.today()
    return today.year if (today.month, today.day) >= (3, 15) else today.year - 1


def _calendar(index: int) -> Column:
    """Season edge of the year in hand, as a map literal: the table is fixed and tiny."""
    pairs = [part for year, days in schemas.SEASONS.items() for part in (F.lit(year), F.lit(days[index]).cast("date"))]
    return F.create_map(*pairs)


def _edge(year: Column, index: int) -> Column:
    fallback = F.concat_ws("-", year.cast("string"), F.lit(schemas.UNKNOWN_SEASON[index])).cast("date")
    return F.coalesce(F.try_element_at(_calendar(index), year), fallback)


def season_start(year: Column) -> Column:
    return _edge(year, 0)


def season_end(year: Column) -> Column:
    return _edge(year, 1)


def in_season(day: Column) -> Column:
    """True between the first and last day of the season of that year."""
    year = F.year(day)
    return day.between(season_start(year), season_end(year))


def season_chunks(df: DataFrame, start: str, stop: str, step: int = 7) -> DataFrame:
    """Per row, the chunks of ``step`` days between two date columns.

    A chunk starts at the range start or where the one before it ended; one
    that would start outside the season starts at the next season instead. Ends
    are clipped to the range only. Each row grows its own chunks, one run of
    evenly spaced starts per year, so nothing is shuffled. The result adds
    ``chunk_start`` and ``chunk_end``.
    """
    if step < 1:
        raise InvalidParameter("step must be at least 1.")
    first, last = F.col(start), F.col(stop)

    def extend(state: Column, year: Column) -> Column:
        opening = F.greatest(season_start(year), state["low"])
        closing = F.least(season_end(year), last)
        count = F.floor(F.datediff(closing, opening) / step).cast("int") + 1
        run = F.struct(opening.alias("opening"), closing.alias("closing"))
        return F.when(
            opening <= closing,
            F.struct(
                F.date_add(opening, count * step).alias("low"),
                F.array_append(state["runs"], run).alias("runs"),
            ),
        ).otherwise(state)

    nothing = F.array().cast("array<struct<opening:date,closing:date>>")
    years = F.sequence(F.year(first), F.year(last))
    runs = F.aggregate(years, F.struct(first.alias("low"), nothing.alias("runs")), extend)["runs"]
    per_run = df.where(first <= last).select("*", F.explode(runs).alias("_run"))
    day = F.expr(f"interval {step} days")
    starts = F.explode(F.sequence("_run.opening", "_run.closing", day))
    return (
        per_run.withColumn("chunk_start", starts)
        .withColumn("chunk_end", F.least(F.date_add("chunk_start", step - 1), last))
        .drop("_run")
    )
