"""Readers for landed files: headered CSV, positional CSV, raw event files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter, MissingPartition
from dugout.functions import clean
from dugout.operators.align import diagonal_union, require_rows
from dugout.operators.filters import named_players, team_seasons
from dugout.operators.names import ref
from dugout.operators.typed import known_columns, lenient_casts, strict_table, trim_table
from dugout.sources import schemas

#: Column that takes the first cell beyond the declared ones.
BEYOND = "_beyond"


def read_text_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None, null: str = "") -> DataFrame:
    """Headered CSV with every column as text.

    Cells in quotes may hold commas, doubled quotes and line breaks, so a file is
    read from its start; many landed files are still many tasks. Given
    ``columns`` the header is not sampled, so planning reads no data.
    """
    reader = spark.read.option("header", True).option("nullValue", null).option("enforceSchema", False)
    reader = reader.option("multiLine", True).option("escape", '"')
    if columns is not None:
        reader = reader.schema(schemas.struct(dict.fromkeys(columns, "string")))
    return reader.csv(path)


def read_pitch_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Landed pitch or leaderboard CSV: trimmed, empty as null, known columns typed."""
    return lenient_casts(trim_table(read_text_csv(spark, path, columns)), schemas.CSV_OVERRIDES)


def read_mixed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Landed pitch CSV files whose headers differ, in one table.

    The first line of every file is read once; files with the same header are one
    scan, and the scans are aligned by column name.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    # The first block of a file is one task, which sees its lines in order.
    heads = lines.where("file_block_start = 0").groupBy("file_path").agg(F.first("value").alias("head"))
    groups: dict[str, list[str]] = {}
    for row in heads.orderBy("file_path").collect():  # a name and a header line per landed file
        groups.setdefault(row["head"], []).append(row["file_path"])
    if not groups:
        raise MissingPartition(f"No CSV file in {path}.")
    return diagonal_union(*[read_pitch_csv(spark, paths) for _, paths in sorted(groups.items())])


def read_leaderboard(
    spark: SparkSession,
    root: str,
    board: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One named board from ``root/board/`` with the board name as a column.

    ``year=`` and ``player_type=`` folders below it become columns.
    """
    if board not in schemas.LEADERBOARDS:
        raise InvalidParameter(f"Unknown leaderboard: {board}")
    table = read_pitch_csv(spark, f"{root.rstrip('/')}/{board}", columns)
    if board == "catcher_framing":
        name = next((c for c in ("name", "player_name", "last_name, first_name") if c in table.columns), None)
        table = table if name is None else named_players(table, name, None)
    return table.withColumn("board", F.lit(board))


def read_war(spark: SparkSession, path: str, kind: str = "bat", all_columns: bool = False) -> DataFrame:
    """Wins-above-replacement CSV, strictly typed; by default the typed columns only."""
    types = {"bat": schemas.WAR_BATTING, "pitch": schemas.WAR_PITCHING}[kind]
    table = strict_table(read_text_csv(spark, path, null="NULL"), schemas.WAR_REQUIRED, types)
    return table if all_columns else known_columns(table, types)


def read_crosswalk(spark: SparkSession, path: str, season: int | None = None, league: str = "ALL") -> DataFrame:
    """Team identifiers across systems, by season and league."""
    table = strict_table(read_text_csv(spark, path), schemas.CROSSWALK_REQUIRED, schemas.CROSSWALK)
    return team_seasons(table, season, league)


def read_positional(spark: SparkSession, path: str | list[str], columns: Sequence[str], cut: bool = False) -> DataFrame:
    """Headerless CSV; short rows are padded with nulls.

    A row with more cells than columns fails the job, unless long rows are to be ``cut``.
    """
    table = spark.read.schema(schemas.struct(dict.fromkeys([*columns, BEYOND], "string"))).option("mode", "PERMISSIVE").csv(path)
    if not cut:
        message = F.concat(F.lit(f"a row has more than {len(columns)} cells: "), ref(BEYOND))
        table = table.where(F.when(ref(BEYOND).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return table.drop(BEYOND)


def long_rows(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """The rows of headerless CSV that have more cells than columns, with the first cell beyond."""
    table = spark.read.schema(schemas.struct(dict.fromkeys([*columns, BEYOND], "string"))).option("mode", "PERMISSIVE").csv(path)
    return table.where(ref(BEYOND).isNotNull())


def read_game_logs(spark: SparkSession, path: str | list[str], numbers: Sequence[str] = ()) -> DataFrame:
    """Game logs; the columns named in ``numbers`` are read as whole numbers."""
    table = read_positional(spark, path, schemas.GAME_LOG_FILE, cut=True)
    return lenient_casts(table, dict.fromkeys(numbers, "bigint")) if numbers else table


def read_rosters(spark: SparkSession, folder: str) -> DataFrame:
    """All roster files of a season folder in one scan; a folder without any is an error."""
    try:
        return read_positional(spark, f"{folder.rstrip('/')}/*.ROS", schemas.ROSTER_FILE)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise MissingPartition(f"{folder} has no roster files.") from problem
        raise


def read_schedules(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_positional(spark, path, schemas.SCHEDULE_FILE)


def read_park_codes(spark: SparkSession, path: str) -> DataFrame:
    """Headered file whose first columns get new names by position."""
    table = read_text_csv(spark, path)
    names = list(schemas.PARK_CODE_FILE)[: len(table.columns)]
    return table.toDF(*names, *table.columns[len(names) :])


def read_event_files(spark: SparkSession, folder: str, season: int, game_type: str = "regular") -> DataFrame:
    """One row per raw event file of a season, bytes untouched."""
    if game_type not in schemas.EVENT_SUFFIXES:
        raise InvalidParameter(f"game_type must be one of: {', '.join(schemas.EVENT_SUFFIXES)}.")
    suffixes = schemas.EVENT_SUFFIXES[game_type]
    glob = "*{" + ",".join(suffixes) + "}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    require_rows(files.select("path"), f"{folder} has no {game_type} event files.")
    return files.select(
        F.lit(season).cast("bigint").alias("season"),
        F.lit(game_type).alias("event_type"),
        F.substring_index("path", "/", -1).alias("filename"),
        "content",
    )


def listing(payloads: DataFrame, body: str = "body", required: bool = False) -> DataFrame:
    """File names of a season listing, a JSON array of objects with a name; none at all is an error if they are ``required``."""
    variant = F.try_parse_json(ref(body))
    entries = F.try_variant_get(variant, "$", "array<variant>")
    names = payloads.select("*", F.explode(entries).alias("_entry"))
    name = F.try_variant_get("_entry", "$.name", "string")
    found = names.select(*[ref(c) for c in payloads.columns], name.alias("name")).where(F.col("name").isNotNull())
    return require_rows(found, "The listing names no file.") if required else found


def decoded(files: DataFrame, content: str = "content", name: str = "text") -> DataFrame:
    return files.withColumn(name, clean.utf8_or_latin1(ref(content)))
