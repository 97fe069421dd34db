"""The season-partitioned pitch dataset and the queries on it."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter, MissingPartition, SchemaMismatch
from dugout.operators import seasons as cal
from dugout.operators.align import diagonal_union
from dugout.operators.names import ref, types_of
from dugout.operators.typed import canonical_table
from dugout.session import folder
from dugout.sources import schemas

YEAR = schemas.SEASON_COLUMN
UNDATED = "A row has no readable"


def _season_list(seasons: int | Iterable[int] | None, first: int, last: int) -> list[int] | None:
    if seasons is None:
        return None
    wanted = sorted({seasons} if isinstance(seasons, int) else set(seasons))
    wrong = [s for s in wanted if not first <= s <= last]
    if wrong:
        raise InvalidParameter(f"Seasons outside {first} to {last}: {wrong}")
    return wanted


def stored_seasons(spark: SparkSession, root: str) -> list[int]:
    """Seasons with a partition folder; one listing, as long as there are seasons."""
    prefix = f"{YEAR}="
    names = [name.removeprefix(prefix) for name in folder(spark, root).subfolders() if name.startswith(prefix)]
    return sorted(int(name) for name in names if name.isdigit())


def season_rows(pitches: DataFrame, seasons: Iterable[int], day: str = "game_date", undated: str = "drop") -> DataFrame:
    """Rows of the calendar years, with the year as a column.

    The years' first and last day bound the column itself as well, so that the
    filter reaches the scan. Rows without a readable date are left out, or fail the
    job when ``undated`` is ``"fail"``.
    """
    wanted = sorted(seasons)
    read, inside = ref(day).try_cast("date"), None
    if wanted:
        inside = _year_range(types_of(pitches)[day], ref(day), wanted[0], wanted[-1])
    if undated == "fail":
        inside = None if inside is None else inside | read.isNull()
        text = F.concat(F.lit(f"{UNDATED} {day}: "), F.coalesce(ref(day).cast("string"), F.lit("null")))
        read = F.coalesce(read, F.raise_error(text).cast("date"))
    ranged = pitches if inside is None else pitches.where(inside)
    return ranged.withColumn(YEAR, F.year(read)).where(ref(YEAR).isin(wanted))


def _year_range(kind: str, day: Column, first: int, last: int) -> Column:
    """A plain comparison that no date of the years fails; text is compared by its year, as ISO dates are."""
    if kind == "string":
        # A date may stand after blanks, which sort before digits: only the upper end can be told.
        return day < F.lit(f"{last + 1}")
    return (day >= F.lit(date(first, 1, 1))) & (day < F.lit(date(last + 1, 1, 1)))


def season_rejects(pitches: DataFrame, day: str = "game_date") -> DataFrame:
    """Rows without a readable date, which belong to no season."""
    return pitches.where(ref(day).try_cast("date").isNull())


def write_seasons(
    pitches: DataFrame,
    root: str,
    seasons: int | Iterable[int],
    force: bool = False,
    types: dict[str, str] | None = None,
    day: str = "game_date",
    cluster: Iterable[str] = ("game_date", "game_pk"),
    first: int = schemas.FIRST_PITCH_SEASON,
    last: int | None = None,
    undated: str = "fail",
) -> DataFrame:
    """Write one partition per season and report season, path and whether it was written.

    Stored seasons are kept unless ``force``; the filter is applied before
    anything is read, and only the written partitions are replaced. A season
    without rows is not written, and with ``force`` its old partition goes. Rows
    without a readable date fail the job, unless ``undated`` is ``"drop"``;
    ``season_rejects`` lists them. Rows are rebalanced by season, where adaptive
    execution splits a big season over many tasks and files, and sorted within
    files so that later date filters skip row groups.
    """
    if undated not in ("fail", "drop"):
        raise InvalidParameter("undated is either 'fail' or 'drop'.")
    spark = pitches.sparkSession
    wanted = _season_list(seasons, first, last or cal.current_season())
    kept = set() if force else set(stored_seasons(spark, root))
    todo = [s for s in wanted if s not in kept]
    written: set[int] = set()
    if todo:
        types = schemas.PITCH if types is None else types
        # The landed table is read once: undated rows end the write, which then leaves all as it was, and
        # the rows of each season are counted as they pass.
        counted = Observation()
        found = season_rows(pitches, todo, day, undated).observe(counted, *[F.count_if(ref(YEAR) == s).alias(str(s)) for s in todo])
        rows = canonical_table(found.withColumnRenamed(YEAR, "_y"), types)
        spread = rows.withColumnRenamed("_y", YEAR).hint("rebalance", YEAR)
        order = [ref(c) for c in cluster if c in rows.columns]
        ordered = spread.sortWithinPartitions(ref(YEAR), *order)
        try:
            ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(root)
        except Exception as problem:
            if UNDATED in str(problem):
                start = str(problem).index(UNDATED)
                raise SchemaMismatch(str(problem)[start:].splitlines()[0]) from problem
            raise
        written = {int(name) for name, n in counted.get.items() if n}
        for gone in set(todo) & set(stored_seasons(spark, root)) - written:
            folder(spark, f"{root.rstrip('/')}/{YEAR}={gone}").delete()
    report = [(s, f"{root.rstrip('/')}/{YEAR}={s}", s in written) for s in wanted]
    return spark.createDataFrame(report, "season int, path string, written boolean")


def write_chunks(chunks: Iterable[DataFrame], root: str, seasons, **options) -> DataFrame:
    """Write seasons assembled from several landed tables, aligned first."""
    return write_seasons(diagonal_union(*chunks), root, seasons, **options)


def scan_seasons(
    spark: SparkSession,
    root: str,
    seasons: int | Iterable[int] | None = None,
    types: dict[str, str] | None = None,
    extras: bool = False,
    first: int = schemas.FIRST_PITCH_SEASON,
    last: int | None = None,
) -> DataFrame:
    """Lazy scan of stored seasons with the season as a column.

    The schema is declared, so no file footer is read for it and absent columns
    are null. ``extras`` also brings undeclared columns, at the price of reading
    footers. The season filter prunes partitions.
    """
    types = schemas.PITCH if types is None else types
    wanted = _season_list(seasons, first, last or cal.current_season())
    have = stored_seasons(spark, root)
    if not have and wanted is None:
        return spark.createDataFrame([], schemas.struct({**types, YEAR: "int"}))
    absent = [s for s in wanted or [] if s not in have]
    if absent:
        raise MissingPartition(f"Seasons not in the dataset: {absent}")
    if extras:
        stored = spark.read.option("mergeSchema", "true").option("basePath", root).parquet(root)
        table = canonical_table(stored, types)
    else:
        table = spark.read.schema(schemas.struct({**types, YEAR: "int"})).parquet(root)
    return table if wanted is None else table.where(ref(YEAR).isin(wanted))


def sort_pitches(pitches: DataFrame, order: Iterable[str] = schemas.PITCH_ORDER, nulls_first: bool = True) -> DataFrame:
    """Newest pitch first, by the order columns that exist.

    Used on query results only; the dataset write sorts within files.
    """
    keys = [ref(c).desc_nulls_first() if nulls_first else ref(c).desc_nulls_last() for c in order if c in pitches.columns]
    return pitches.orderBy(*keys) if keys else pitches


def pitches_between(
    pitches: DataFrame,
    start: str | date | None = None,
    end: str | date | None = None,
    team: str | None = None,
    day: str = "game_date",
    order: Iterable[str] = schemas.PITCH_ORDER,
    in_season_only: bool = True,
) -> DataFrame:
    """Pitches of a date range, in-season days only, newest first.

    Catalyst cannot derive the season from the date, so the partition filter is
    added here where the table has the season column.
    """
    low, high = cal.date_range(start, end)
    rows = _dated(pitches, low, high, day)
    if in_season_only:
        rows = rows.where(cal.in_season(ref(day).try_cast("date")))
    if team is not None:
        rows = rows.where((ref("home_team") == team) | (ref("away_team") == team))
    return sort_pitches(rows, order)


def _dated(pitches: DataFrame, low: date, high: date, day: str) -> DataFrame:
    kind = types_of(pitches)[day]
    # ISO text compares like dates, which keeps the filter pushable.
    bounds = (low.isoformat(), high.isoformat()) if kind == "string" else (F.lit(low), F.lit(high))
    if kind.startswith("timestamp"):
        rows = pitches.where((ref(day) >= F.lit(low)) & (ref(day) < F.date_add(F.lit(high), 1)))
    else:
        rows = pitches.where(ref(day).between(*bounds))
    return rows.where(ref(YEAR).between(low.year, high.year)) if YEAR in pitches.columns else rows


def game_pitches(pitches: DataFrame, game: int, column: str = "game_pk", order: Iterable[str] = schemas.PITCH_ORDER) -> DataFrame:
    return sort_pitches(pitches.where(ref(column) == game), order)


def player_pitches(
    pitches: DataFrame,
    player: int | None,
    start: str | date | None = None,
    end: str | date | None = None,
    role: str = "batter",
    day: str = "game_date",
    order: Iterable[str] = schemas.PITCH_ORDER,
) -> DataFrame:
    """Pitches of one batter or pitcher over a date range, newest first."""
    if player is None:
        raise InvalidParameter("A player ID is required; find one with find_player.")
    low, high = cal.date_range(start, end)
    return sort_pitches(_dated(pitches, low, high, day).where(ref(role) == player), order)
