"""Ranks, shares and latest rows, planned so that no group sits in one task.

A window over a group sorts the whole group in one task. Where the window only
keeps the first rows, Spark prunes on the map side (``WindowGroupLimit``), so it
is used as it is. Everything else here aggregates first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter
from dugout.operators.names import ref, refs

RANK_BUCKETS = 256
#: Values per metric whose ranks every task looks up beside its rows.
FREQUENT = 512


def share_of_total(counts: DataFrame, value: str, name: str, scale: float = 100.0, digits: int | None = None) -> DataFrame:
    """Each row's part of the column total.

    ``counts`` is aggregated: a few rows per category. They meet in one window,
    so that the table below is read once.
    """
    return share_within(counts, [], value, name, scale, digits)


def share_within(counts: DataFrame, by: Sequence[str], value: str, name: str, scale: float = 100.0, digits: int | None = None) -> DataFrame:
    """Each row's part of its group's total; rows are already aggregated."""
    share = ref(value) * F.lit(scale) / F.sum(ref(value)).over(Window.partitionBy(*refs(by)))
    return counts.withColumn(name, share if digits is None else F.round(share, digits))


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order; pruned before the shuffle."""
    window = Window.partitionBy(*refs(keys)).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def leaders(df: DataFrame, by: Sequence[str], order: Sequence[Column], limit: int, rank: str = "rank") -> DataFrame:
    """Rows ranked within their group, ties sharing a rank, down to ``limit``."""
    window = Window.partitionBy(*refs(by)).orderBy(*order)
    return df.withColumn(rank, F.rank().over(window)).where(ref(rank) <= limit)


def top(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first rows of the whole table: a top-k per partition, then one merge."""
    return df.orderBy(*order).limit(limit)


def sorted_by(df: DataFrame, columns: Sequence[str], descending: bool | Sequence[bool] = False, nulls_last: bool = False) -> DataFrame:
    """Rows by several columns, each in its own direction or all in one; nulls come first unless asked otherwise."""
    down = [descending] * len(columns) if isinstance(descending, bool) else list(descending)
    if len(down) != len(columns):
        raise InvalidParameter(f"{len(columns)} columns and {len(down)} directions.")
    kinds = {(False, False): "asc_nulls_first", (False, True): "asc_nulls_last", (True, False): "desc_nulls_first", (True, True): "desc_nulls_last"}
    return df.orderBy(*[getattr(ref(c), kinds[d, nulls_last])() for c, d in zip(columns, down, strict=True)])


def percent_ranks(
    df: DataFrame, by: Sequence[str], metric: str, name: str = "percent_rank", scale: float = 1.0, buckets: int = RANK_BUCKETS
) -> DataFrame:
    """``percent_rank`` per group for groups of any size; nulls rank first."""
    return percent_ranks_of(df, by, {metric: name}, scale, buckets)


def percent_ranks_of(
    df: DataFrame, by: Sequence[str], names: dict[str, str], scale: float = 1.0, buckets: int = RANK_BUCKETS, frequent: int = FREQUENT
) -> DataFrame:
    """``percent_rank`` of several metrics; ``names`` maps a metric to its rank column.

    The metrics become (metric, value) rows once and are ranked together, so the
    plan does not grow with them. Equal values are first counted together, so a
    frequent value is one row. Those rows are cut into ordered buckets at
    approximate quantiles of the metric; a window only ever sees one bucket of one
    group, and what lies in the buckets before it is added from their totals.
    Where the cuts fall has no influence on the result.

    The most frequent values, ``frequent`` per metric on average and no more than that in all, are
    looked up beside the rows. Only rows that hold another value go through a shuffle, and only with
    those values.
    """
    steps = [i / buckets for i in range(1, buckets)]
    wide = names if len({df.schema[m].dataType for m in names}) == 1 else None
    cells = F.array(*[F.struct(F.lit(i).alias("_m"), (ref(m) if wide else ref(m).cast("double")).alias("_v")) for i, m in enumerate(names)])
    long = df.select(*refs(by), F.explode(cells).alias("_c")).select(*refs(by), "_c._m", "_c._v")
    values = long.groupBy(*refs(by), "_m", "_v").agg(F.count(F.lit(1)).alias("_n"))
    cuts = long.groupBy("_m").agg(F.percentile_approx("_v", steps, 10 * buckets).alias("_cuts"))  # one row per metric
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col("_v")))
    bucketed = values.join(cuts, "_m").withColumn("_bucket", F.when(F.col("_v").isNull(), F.lit(-1)).otherwise(below)).drop("_cuts")
    keys = [*by, "_m"]
    cell = bucketed.groupBy(*refs(keys), "_bucket").agg(F.sum("_n").alias("_cell"))
    whole_group = Window.partitionBy(*refs(keys))
    before = whole_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cell.select(
        *refs(keys),
        "_bucket",
        F.coalesce(F.sum("_cell").over(before), F.lit(0)).alias("_before"),
        F.sum("_cell").over(whole_group).alias("_rows"),
    )
    inside = Window.partitionBy(*refs(keys), "_bucket").orderBy(F.col("_v").asc_nulls_first())
    local = bucketed.withColumn(
        "_inside", F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    share = F.when(F.col("_rows") == 1, F.lit(0.0)).otherwise((F.col("_before") + F.col("_inside")).cast("double") / (F.col("_rows") - 1))
    placed = _null_safe(local, offsets, [*keys, "_bucket"]).select(
        *[F.col(f"l.`{c}`") for c in [*keys, "_v", "_n"]], (share if scale == 1.0 else share * scale).alias("_share")
    )
    # Ordered to the last column, so that every evaluation takes the same values.
    common = top(placed.where(F.col("_v").isNotNull()), [F.desc("_n"), *refs(keys), F.col("_v")], frequent * len(names))
    at = lambda i: F.collect_set(F.when(F.col("_m") == i, F.struct("_v", "_share")))
    looked_up = common.groupBy(*refs(by)).agg(*[F.map_from_entries(at(i)).alias(f"_k{i}") for i in range(len(names))])
    beside = df.alias("l").join(looked_up.hint("broadcast").alias("r"), _same(by), "left")
    # Nulls rank first, all of them with 0.
    known = [
        F.when(value.isNull(), F.lit(0.0)).otherwise(F.try_element_at(F.col(f"r._k{i}"), value))
        for i, value in enumerate(F.col(f"l.`{m}`") if wide else F.col(f"l.`{m}`").cast("double") for m in names)
    ]
    found_all = reduce(Column.__and__, [share.isNotNull() for share in known])
    done = beside.where(found_all).select("l.*", *[share.alias(name) for share, name in zip(known, names.values(), strict=True)])
    rest = beside.where(~found_all).select("l.*", F.array(*known).alias("_known"))
    if len(names) == 1:
        ((metric, name),) = names.items()
        joined = _null_safe(rest.drop("_known"), placed.withColumnRenamed("_v", metric), [*by, metric])
        return done.union(joined.select("l.*", F.col("_share").alias(name)))
    # One join for all metrics: rows with their unknown values side by side, each looked up in its own place.
    row = F.struct(*refs([*df.columns, "_known"])).alias("_row")
    unknown = F.filter(cells, lambda c: F.get("_known", c["_m"]).isNull())
    spread = rest.select(*refs(by), row, F.monotonically_increasing_id().alias("_id"), unknown.alias("_cs"))
    each = spread.select(*refs(by), "_id", "_row", F.posexplode("_cs").alias("_at", "_c")).select(*refs(by), "_id", "_row", "_at", "_c._m", "_c._v")
    each = each.withColumn("_row", F.when(F.col("_at") == 0, F.col("_row")))
    ranked = _null_safe(each, placed, [*keys, "_v"]).select("l._id", "l._row", F.col("l._m").alias("_m"), "_share")
    found = ranked.groupBy("_id").agg(
        F.any_value("_row", True).alias("_row"), *[F.max(F.when(F.col("_m") == i, F.col("_share"))).alias(f"_s{i}") for i in range(len(names))]
    )
    shares = [F.coalesce(F.get("_row._known", F.lit(i)), F.col(f"_s{i}")).alias(name) for i, name in enumerate(names.values())]
    return done.union(found.select(*[F.col(f"_row.`{c}`") for c in df.columns], *shares))


def _same(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in keys] or [F.lit(True)]


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.alias("l").join(right.alias("r"), _same(keys))


def without_last(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Drop the row with the highest position of every key (a totals line)."""
    ends = df.groupBy(*refs(keys)).agg(F.max(ref(position)).alias(position))
    same = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in [*keys, position]]
    return df.alias("l").join(ends.alias("r"), same, "left_anti")


def best_item(items: Column, score) -> Column:
    """The highest-scoring element of an array, the first on ties; nulls are no candidates.

    Works inside the row: no explode and no shuffle.
    """
    scored = F.transform(
        F.filter(items, lambda item: item.isNotNull()), lambda item: F.struct(score(item).alias("score"), item.alias("item"))
    )
    # A lower position wins among equals, so it is compared negated.
    placed = F.transform(scored, lambda s, i: F.struct(s["score"].alias("score"), (-i).alias("place"), s["item"].alias("item")))
    return F.array_max(placed)["item"]
