"""Historical archive: CSV tables compiled to Parquet once, and their manifest."""

from __future__ import annotations

import csv
import io
import itertools
import re
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter, MissingPartition
from dugout.operators.names import ref
from dugout.operators.typed import trim_table
from dugout.sources import schemas


#: Records of a member that are handed over at once.
RECORDS_AT_ONCE = 5_000


def table_file(name: str) -> str:
    """Archive member of a table given as ``Batting``, ``batting`` or ``core/Batting.csv``."""
    key = name.replace("_", "").lower()
    for member in schemas.ARCHIVE_TABLES:
        folder, stem = member.removesuffix(".csv").split("/")
        if key in (member.lower(), stem.lower()) and (folder == "core" or key != "teams"):
            return member
        if key in (f"{stem}{folder}".lower(), f"{folder}/{stem}".lower()):
            return member
    raise InvalidParameter(f"Unknown archive table: {name}")


def _compiled_path(root: str, member: str) -> str:
    return f"{root.rstrip('/')}/{member.removesuffix('.csv').replace('/', '_')}"


def compile_table(spark: SparkSession, landed: str, compiled: str, name: str, schema=None) -> DataFrame:
    """CSV to Parquet, once; later reads never touch the CSV again.

    Without a schema, types are inferred here, in the compile step only.
    """
    member = table_file(name)
    reader = spark.read.option("header", True).option("nullValue", "").option("multiLine", True).option("escape", '"')
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    target = _compiled_path(compiled, member)
    reader.csv(f"{landed.rstrip('/')}/{member}").write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def read_table(spark: SparkSession, compiled: str, name: str) -> DataFrame:
    return spark.read.parquet(_compiled_path(compiled, table_file(name)))


def unzip_members(spark: SparkSession, archives: str, pattern: str) -> DataFrame:
    """Matching members of landed ZIP archives, one row each.

    Archives are spread over tasks; a member is read where its archive lies.
    """
    files = spark.read.format("binaryFile").load(archives).select("path", "content")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in batch.itertuples(index=False):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    members = [m for m in archive.namelist() if re.search(pattern, m)]
                    for member in members:
                        yield pd.DataFrame({"path": [path], "member": [member], "content": [archive.read(member)]})

    return files.mapInPandas(extract, "path string, member string, content binary")


def _named_cells(member: str, head: list[str], cells: list[str]) -> dict[str, str]:
    if len(cells) > len(head):
        raise ValueError(f"{member}: a row of {len(cells)} cells under {len(head)} headings: {cells[:5]}")
    return dict(zip(head, cells, strict=False))


def csv_from_archive(spark: SparkSession, archives: str, pattern: str, target: str) -> DataFrame:
    """The matching members as one table, landed as Parquet below ``target`` and typed from there.

    Every member has its own header line; cells in quotes may hold commas, doubled
    quotes and line breaks. Members are read record by record where their archive
    lies, and land as (member, cells by name). A shorter row ends in nulls, a row longer than its
    header fails the job.
    """
    files = spark.read.format("binaryFile").load(archives).select("content")

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in [m for m in archive.namelist() if re.search(pattern, m)]:
                        with archive.open(member) as raw:
                            lines = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline=""))
                            head = [name.strip() for name in next(lines, [])]
                            rows = (_named_cells(member, head, cells) for cells in lines if cells)
                            yield pd.DataFrame({"member": [member], "head": [head], "cells": [{}]})  # a member without rows counts too
                            while chunk := list(itertools.islice(rows, RECORDS_AT_ONCE)):
                                size = len(chunk)
                                yield pd.DataFrame({"member": [member] * size, "head": [None] * size, "cells": chunk})

    landed = files.mapInPandas(records, "member string, head array<string>, cells map<string,string>")
    landed.write.mode("overwrite").parquet(f"{target.rstrip('/')}/records")
    read = spark.read.parquet(f"{target.rstrip('/')}/records")
    heads = [r["head"] for r in read.where("head is not null").select("head").distinct().orderBy("head").collect()]  # one per kind of member
    if not heads:
        raise MissingPartition(f"No archive member matches {pattern!r}.")
    names = list(dict.fromkeys(name for head in heads for name in head))
    rows = read.where("head is null").select(*[F.try_element_at("cells", F.lit(n)).alias(n) for n in names])
    # Types are found by Spark's own CSV reader, on the rows as one uniform file set.
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{target.rstrip('/')}/table")
    table = spark.read.option("header", True).option("inferSchema", True).option("nullValue", "").option("multiLine", True)
    return trim_table(table.option("escape", '"').csv(f"{target.rstrip('/')}/table"))


def content_hash(df: DataFrame) -> F.Column:
    """Hash of a table's rows that does not depend on their order."""
    return F.sum(F.xxhash64(*[ref(c) for c in df.columns]).cast("decimal(38,0)")).cast("string")


def manifest(tables: Iterable[tuple[str, str, DataFrame]]) -> DataFrame:
    """Per table: name, path, rows, column types, and a content hash.

    One aggregate per table, joined by union; nothing is collected.
    """
    entries = [
        df.agg(F.count(F.lit(1)).alias("rows"), content_hash(df).alias("checksum")).select(
            F.lit(name).alias("table_name"),
            F.lit(path).alias("path"),
            "rows",
            F.lit(len(df.columns)).alias("n_columns"),
            F.lit(df.schema.json()).alias("column_types"),
            "checksum",
        )
        for name, path, df in tables
    ]
    whole = entries[0]
    for entry in entries[1:]:
        whole = whole.unionByName(entry)
    return whole
