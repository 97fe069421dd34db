"""The landing table of raw payloads and what is done before they are parsed.

Columns: ``provider``, ``url``, ``params`` (a map), ``fetched_at``, ``body``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.operators.names import ref
from dugout.operators.ranks import latest
from dugout.operators.records import first_cells
from dugout.sources import schemas

LANDING = {
    "provider": "string",
    "url": "string",
    "params": "map<string,string>",
    "fetched_at": "timestamp",
    "body": "string",
}
KEY = "payload_key"

# The heading of an error answer, and the key's schema version.
ERROR_WORD = "error"
KEY_VERSION = 1
#: First and last bytes of a Parquet file.
PARQUET_MARK = b"PAR1"


def read_landing(spark: SparkSession, path: str, provider: str | None = None, skip_unreadable: bool = False) -> DataFrame:
    """Landed payloads. A file that cannot be read fails the job, unless it is to be skipped.

    ``unreadable_files`` names those that would be.
    """
    reader = spark.read.schema(schemas.struct(LANDING)).option("ignoreCorruptFiles", str(skip_unreadable).lower())
    table = reader.parquet(path)
    return table if provider is None else table.where(ref("provider") == provider)


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``length`` of landed files that give no rows: those no reader gets through.

    The folder's files are listed, without their contents; what a lenient scan of
    the row positions reaches is taken away. Only the files that are left, by an
    explicit list of their paths, are opened: a whole one holds its footer between
    two marks and has no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    whole = spark.read.option("ignoreCorruptFiles", "true").schema("fetched_at timestamp").parquet(path)
    reached = whole.select(F.col("_metadata.file_path").alias("path")).distinct()
    suspects = files.select("path", "length").join(reached, "path", "left_anti")
    found = suspects.collect()
    suspects = spark.createDataFrame(found, suspects.schema)
    if not found:
        return suspects
    content = spark.read.format("binaryFile").load([row["path"] for row in found]).select("path", "content")
    mark = F.lit(PARQUET_MARK)
    sound = (F.substring("content", 1, 4) == mark) & (F.substring("content", -4, 4) == mark)
    return suspects.join(content.where(sound).select("path"), "path", "left_anti")


def payload_key(url: Column, params: Column, version: int = KEY_VERSION) -> Column:
    """Key of a request: the same URL and parameters in any order give the same key."""
    pairs = F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    text = F.concat(F.lit(f"{version}:"), url, F.lit("?"), F.array_join(F.coalesce(pairs, F.array()), "&"))
    return F.md5(text.cast("binary"))


def query_params(url: Column) -> Column:
    """Parameters of a URL as a map."""
    query = F.substring_index(F.substring_index(url, "#", 1), "?", -1)
    return F.str_to_map(F.when(F.contains(url, F.lit("?")), query), F.lit("&"), F.lit("="))


def with_key(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn(KEY, payload_key(ref("url"), ref("params")))


def latest_payloads(payloads: DataFrame, max_age: str | None = None, now: Column | None = None) -> DataFrame:
    """Newest payload per key, and only if it is not older than ``max_age``.

    The age filter comes first: it can only remove keys whose newest is too old.
    """
    fresh = payloads
    if max_age is not None:
        moment = F.current_timestamp() if now is None else now
        fresh = payloads.where(ref("fetched_at") >= moment - F.expr(f"interval {max_age}"))
    return latest(with_key(fresh), [KEY], [F.desc("fetched_at")])


def looks_rejected(body: Column) -> Column:
    """An answer that reports an error instead of data: a heading of its first line is ``error``."""
    return F.array_contains(_headings(body), ERROR_WORD)


def _headings(body: Column) -> Column:
    return F.transform(first_cells(body), lambda h: F.lower(F.trim(h)))


def split_rejected(payloads: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Good and rejected payloads; the rejected carry the reason.

    In an error answer the column headed ``error`` holds the reason; without one
    the whole body is the reason. Null bodies are rejected.
    """
    bad = F.coalesce(looks_rejected(ref(body)), F.lit(True))
    position = F.array_position(_headings(ref(body)), ERROR_WORD)
    cell = F.get(first_cells(ref(body), skip=1), position.cast("int") - 1)
    reason = F.nullif(F.regexp_extract(cell, r"\A\s*([^\r\n]*)", 1), F.lit(""))
    rejected = payloads.where(bad).withColumn("reason", F.coalesce(reason, ref(body)))
    return payloads.where(~bad), rejected
