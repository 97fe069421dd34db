"""Helpers shared by the operators: texts, Arrow batches, the shared folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Rows and bytes after which a batch is handed back, whichever comes first.
BATCH_ROWS = 1024
BATCH_BYTES = 4 << 20
#: Bytes of a batch that Spark hands to Python; by rows alone, a batch of long texts has no bound. A task holds
#: a batch several times over: outside the heap while it grows, in the pipe, in Python, once for each function in a row.
INPUT_BYTES = 4 << 20


def whole_text(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, as ``--py-files`` would; once each."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(INPUT_BYTES))
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        folder = Path(tempfile.mkdtemp()).resolve()  # the driver serves the file as long as it lives
        spark.sparkContext.addPyFile(shutil.make_archive(str(folder / "dugout"), "zip", root, "dugout"))
        _SHIPPED.add(application)


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that all executors reach; it must be configured."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors can reach")
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_chunks(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[list[list]]:
    """Columns of a few hundred rows at a time as Python lists; a batch is never a list as a whole."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield [column.to_pylist() for column in part.columns]


class Output:
    """Collects rows and gives out Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema
        self._clear()

    def _clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.bytes = 0

    def add(self, row: tuple, weight: int) -> bool:
        """Take a row; true when the batch should be given out."""
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)
        self.bytes += weight
        return len(self.columns[0]) >= BATCH_ROWS or self.bytes >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema, strict=True)]
        self._clear()
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def per_row(make: Callable, schema: pa.Schema) -> Callable:
    """A function for ``mapInArrow``: ``make(*cells)`` gives the output row and its size in bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Output(schema)
        for columns in row_chunks(batches):
            for cells in zip(*columns, strict=True):
                if out.add(*make(*cells)):
                    yield out.batch()
        if out.columns[0]:
            yield out.batch()

    return run


def per_batch(encode: Callable, schema: pa.Schema) -> Callable:
    """A function for ``mapInArrow``: ``encode(rows)`` takes (key, text) rows and yields (key, bytes) as soon as it likes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Output(schema)
        rows = (row for columns in row_chunks(batches) for row in zip(*columns, strict=True))
        for key, ids in encode(rows):
            if out.add((key, ids), len(ids)):
                yield out.batch()
        if out.columns[0]:
            yield out.batch()

    return run


def by_different(pieces: list[str], encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces in a row, and where each piece's end.

    Every different piece is encoded once: ``encode`` gives all their ids in a row and how many each has.
    """
    coded = pa.array(pieces, pa.string()).dictionary_encode()
    ids, counts = encode(coded.dictionary)
    codes = coded.indices.to_numpy()
    n = counts[codes]
    ends = np.cumsum(n)
    first = (np.cumsum(counts) - counts)[codes] - (ends - n)
    return ids[np.repeat(first, n) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


def in_batches(
    rows: Iterable[tuple], cut: Callable[[str], Iterator[bytes | list[str]]], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], held: int
) -> Iterator[tuple]:
    """For rows of a key and a text: the key and the text's ids.

    ``cut`` gives a text as lists of pieces and as ids that are known; ``held`` pieces are encoded
    together by ``encode``, which gives their ids in a row and where each piece's end.
    """
    waiting: list[tuple] = []
    flat: list[str] = []

    def flush() -> None:
        found, ends = encode(flat)
        ends = np.concatenate([[0], ends])
        at = 0
        for _, parts in waiting:
            for k, part in enumerate(parts):
                if isinstance(part, int):
                    parts[k] = found[ends[at] : ends[at + part]].tobytes()
                    at += part
        flat.clear()

    for key, text in rows:
        parts: list[bytes | int] = []
        waiting.append((key, parts))
        for part in cut(text):
            if isinstance(part, bytes):
                parts.append(part)
                continue
            parts.append(len(part))
            flat += part
            if len(flat) >= held:
                flush()
                for own, ids in waiting[:-1]:
                    yield own, b"".join(ids)
                del waiting[:-1]
    flush()
    for own, ids in waiting:
        yield own, b"".join(ids)


def sample_texts(df: DataFrame, column: str, rows: int, chars: int) -> list[str]:
    """At most ``rows`` different texts for a fit, those with the smallest hashes, each at most ``chars`` long.

    Of a longer text a window is taken, at a place that its hash decides, so that no length keeps a text
    out of the sample. Only hashes are ranked; the windows are fetched by the last hash that is in. The
    sample is empty only where all texts are null or empty.
    """
    start = F.pmod(F.xxhash64(F.lit(1), "text"), F.greatest(F.length("text") - chars + 1, F.lit(1))) + 1
    return sampled(df, column, rows, F.substring("text", start.cast("int"), F.lit(chars)))


def sampled(df: DataFrame, column: str, rows: int, shown: Column) -> list[str]:
    """``shown``, an expression of ``text``, of at most ``rows`` different non-empty texts, those with the smallest hashes."""
    texts = df.select(F.col(column).cast("string").alias("text")).filter("text != ''")
    hashed = texts.withColumn("h", F.xxhash64("text"))
    last = hashed.select("h").distinct().orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if last is None:
        return []
    found = hashed.filter(F.col("h") <= last).select("h", shown.alias("shown"))
    return [r["shown"] for r in found.groupBy("h").agg(F.min("shown").alias("shown")).orderBy("h").collect()]
