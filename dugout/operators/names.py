"""Column references that survive names such as ``W-L%`` or ``visiting_2_id.1``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ref(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def refs(names) -> list[Column]:
    return [ref(name) for name in names]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns in a way that computes them once per row.

    A later filter on a plain derived column is moved below it, where the column
    would be computed again for every mention. Nothing moves below a generator,
    so the columns come out of one that yields a single row. They are made in a
    lambda, which Spark evaluates outside its generated methods: the JVM does not
    compile a method of more than 8,000 bytes, and some twenty casts make one.
    """
    made = F.struct(*[expression.alias(name) for name, expression in columns.items()])
    return df.select("*", F.inline(F.transform(F.array(F.lit(0)), lambda _: made)))


def types_of(df: DataFrame) -> dict[str, str]:
    return {field.name: field.dataType.simpleString() for field in df.schema.fields}
