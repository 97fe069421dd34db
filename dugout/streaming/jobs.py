"""Incremental ingest, repeated polls of live games, and season refresh.

State is only ever the keys seen within the watermark, on the executors' disks. Sinks are idempotent per
batch: a batch that runs twice after a lost executor replaces what it wrote.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dugout.operators.names import ref
from dugout.operators.ranks import latest
from dugout.plans.feeds import LINESCORE, LIVE_FEED
from dugout.plans.flatten import Plan, flatten, rejected
from dugout.session import folder, scratch_path
from dugout.sources import schemas
from dugout.sources.payloads import LANDING
from dugout.sources.pitches import write_seasons

PITCH_KEY = ("gamePk", "atBatIndex", "pitchIndex")
INNING_KEY = ("gamePk", "inning")
SEEN_AT = "seen_at"
PART = "part"
VERSION = "version"
_STORE = "spark.sql.streaming.stateStore"
#: Where ``append`` keeps the keys it has seen. Spark's default is the heap of the executors, with some 170
#: bytes a key and twice that after a second batch; a session that sets the provider keeps its own settings.
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
}


def landed_stream(
    spark: SparkSession, path: str, types: dict[str, str] | None = None, names: str | None = None
) -> DataFrame:
    """Parquet files as they land, with a declared schema; ``names`` is a file glob."""
    reader = spark.readStream.schema(schemas.struct(types or LANDING))
    reader = reader if names is None else reader.option("pathGlobFilter", names)
    return reader.parquet(path)


def append(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what has landed since the last run, then stop."""
    writer = stream.writeStream.format("parquet").option("path", target).outputMode("append")
    with _state_on_disk(stream.sparkSession):
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Settings of a query that starts here, which takes a copy of the session's; a known checkpoint keeps its provider."""
    provider = next(iter(STATE))
    mine = [] if spark.conf.get(provider, None) else [key for key in STATE if spark.conf.get(key, None) is None]
    for key in mine:
        spark.conf.set(key, STATE[key])
    try:
        yield
    finally:
        for key in mine:
            spark.conf.unset(key)


def once_each(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row per key; repeats within the delay are dropped, state expires after it.

    Watermarks need a TIMESTAMP, so other time types are cast.
    """
    timed = stream.withColumn(event_time, ref(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def _timed(plan: Plan) -> Plan:
    """The plan with the poll time of the payload beside every row."""
    return Plan(plan.steps, {**plan.columns, SEEN_AT: ("timestamp", "@fetched_at")}, plan.required, plan.defaults)


def live_pitches(payloads: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Each pitch of re-polled games once, with the time it was first seen.

    Events that are no pitch are told before anything else of them is judged.
    """
    rows = flatten(payloads, _timed(LIVE_FEED), fail=False, only="isPitch", plain=True).drop("isPitch")
    return once_each(rows, PITCH_KEY, SEEN_AT, delay)


def timed_linescores(payloads: DataFrame) -> DataFrame:
    return flatten(payloads, _timed(LINESCORE), fail=False)


def upsert_latest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: str,
    parts: int = 64,
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Keep the newest row per key in a table split into ``parts`` by key hash.

    A batch reads only the parts its keys fall in, merges, and replaces exactly
    those parts; their list is no longer than ``parts``. Rows are staged in the
    shared folder, because a table cannot be overwritten while it is being read,
    and removed afterwards.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = shape(batch) if shape else batch
        hashed = rows.withColumn(PART, F.pmod(F.xxhash64(*[ref(k) for k in keys]), F.lit(parts)).cast("int"))
        news = _staged(latest(hashed, keys, [ref(order).desc()]))
        staged = [news]
        if folder(spark, target).exists():
            rows, _ = news
            touched = [r[PART] for r in rows.select(PART).distinct().collect()]
            kept = spark.read.schema(rows.schema).parquet(target).where(ref(PART).isin(touched))
            staged.append(_staged(latest(rows.unionByName(kept), keys, [ref(order).desc()])))
        merged, _ = staged[-1]
        writer = merged.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PART).parquet(target)
        for _, path in staged:
            folder(spark, path).delete()

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _staged(rows: DataFrame) -> tuple[DataFrame, str]:
    """Rows written to the shared folder and read back, with their path."""
    path = scratch_path(rows.sparkSession, "merge")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def log_latest(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: str, shape: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Append the newest row per key of every batch to a log, which ``latest_rows`` reads.

    A batch writes one folder of its own and touches no other, so its cost is that of its rows. The
    folder is named by checkpoint and batch: a batch that runs twice replaces what it wrote.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        latest(rows, keys, [ref(order).desc()]).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{VERSION}={run}-{batch_id:012d}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def latest_rows(spark: SparkSession, target: str, keys: Sequence[str], order: str) -> DataFrame:
    """The newest row per key of a log; of equally new ones that of the last folder by name."""
    log = spark.read.parquet(target).withColumn(VERSION, ref(VERSION).cast("string"))
    return latest(log, keys, [ref(order).desc(), ref(VERSION).desc()]).drop(VERSION)


def compact_log(spark: SparkSession, target: str, keys: Sequence[str], order: str) -> None:
    """Put the newest rows of a log into one folder and drop the folders that they came from.

    The new folder is whole before the others go; whoever reads in between finds rows twice, of which
    ``latest_rows`` takes one. Folders that are written meanwhile stay.
    """
    prefix = f"{VERSION}="
    old = sorted(name for name in folder(spark, target).subfolders() if name.startswith(prefix))
    if len(old) < 2:
        return
    root = target.rstrip("/")
    log = spark.read.option("basePath", root).parquet(*[f"{root}/{name}" for name in old])
    newest = latest(log.withColumn(VERSION, ref(VERSION).cast("string")), keys, [ref(order).desc(), ref(VERSION).desc()]).drop(VERSION)
    # Named before all batches, as its rows are older than those of any batch still to come.
    newest.write.parquet(f"{root}/{prefix}0-{uuid.uuid4().hex}")
    for name in old:
        folder(spark, f"{root}/{name}").delete()


def current_linescores(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Log of the newest polls of every inning of every game; ``linescores`` reads it."""
    return log_latest(stream, target, checkpoint, INNING_KEY, SEEN_AT, shape=timed_linescores)


def linescores(spark: SparkSession, target: str) -> DataFrame:
    """Newest poll of every inning of every game."""
    return latest_rows(spark, target, INNING_KEY, SEEN_AT)


def append_rejects(payloads: DataFrame, plan: Plan, target: str, checkpoint: str) -> StreamingQuery:
    """Append the rows that a stream of ``plan`` leaves out, with what is wrong with them."""
    return append(rejected(payloads, _timed(plan)), target, checkpoint)


def refresh_seasons(
    stream: DataFrame, root: str, checkpoint: str, seasons: Iterable[int], whole: Callable[[], DataFrame], **options
) -> StreamingQuery:
    """Rewrite the given seasons from the landed table whenever a batch touches one.

    ``whole`` reads the landed table, so a refreshed season is always complete.
    Which seasons a batch touches is found from their short list alone.
    """
    wanted, day = list(seasons), options.get("day", "game_date")

    def rewrite(batch: DataFrame, batch_id: int) -> None:
        year = F.year(ref(day).try_cast("date"))
        flags = batch.agg(*[F.max(year == s).alias(str(s)) for s in wanted]).first()
        touched = [s for s, hit in zip(wanted, flags, strict=True) if hit]
        if touched:
            write_seasons(whole(), root, touched, force=True, **options)

    writer = stream.writeStream.foreachBatch(rewrite).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
