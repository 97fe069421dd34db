"""Aggregations on pitches, games and stat tables.

Each board is one grouped aggregate, so Spark combines rows on the map side and
a single busy pitcher, day or team costs one row per task in the shuffle.
Column names are arguments with the pitch table's names as defaults.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter
from dugout.functions import clean, codes
from dugout.operators.align import first_source, require_rows
from dugout.operators.filters import all_of, at_venues, named_players
from dugout.operators.names import ref, refs
from dugout.operators.ranks import percent_ranks_of, share_of_total, share_within
from dugout.operators.typed import rename_present, strict_table
from dugout.sources import schemas

# Fixed values.
HARD_HIT_SPEED = 95.0
REGRESSION_SIGMA = 3.0


def pitch_mix(pitches: DataFrame, pitch: str = "pitch_type", speed: str = "release_speed") -> DataFrame:
    """Per pitch type: count, mean speed, and share of all pitches in percent."""
    counts = pitches.groupBy(ref(pitch)).agg(
        F.count(F.lit(1)).alias("pitch_count"),
        F.round(F.avg(ref(speed)), 1).alias("avg_velocity"),
    )
    return share_of_total(counts, "pitch_count", "usage_pct", digits=1).orderBy(F.desc("pitch_count"))


def mean_by(df: DataFrame, by: Sequence[str], metric: str, name: str, digits: int | None = None) -> DataFrame:
    mean = F.avg(ref(metric))
    return df.groupBy(*refs(by)).agg((mean if digits is None else F.round(mean, digits)).alias(name))


def fastest(
    pitches: DataFrame,
    limit: int = 5,
    player: str = "player_name",
    pitch: str = "pitch_type",
    speed: str = "release_speed",
    types: Sequence[str] = codes.FASTBALLS,
    name: str = "max_velocity",
) -> DataFrame:
    """Players with the highest single value among the given pitch types."""
    best = pitches.where(ref(pitch).isin(list(types))).groupBy(ref(player)).agg(F.max(ref(speed)).alias(name))
    return best.orderBy(F.desc(name), ref(player)).limit(limit)


def outcome_counts(pitches: DataFrame, by: Sequence[str] = ("pitch_type", "events"), outcome: str = "events") -> DataFrame:
    """Rows per combination, without rows that have no outcome."""
    counts = pitches.where(ref(outcome).isNotNull()).groupBy(*refs(by)).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *refs(by))


def exit_velocity(
    pitches: DataFrame,
    by: Sequence[str] = ("batter",),
    minimum: int = 1,
    speed: str = "launch_speed",
    angle: str = "launch_angle",
    distance: str = "hit_distance_sc",
    hard: float = HARD_HIT_SPEED,
) -> DataFrame:
    """Batted balls per player: speed, angle, distance and the hard-hit share."""
    board = pitches.where(ref(speed).isNotNull()).groupBy(*refs(by)).agg(
        F.count(F.lit(1)).alias("batted_balls"),
        F.avg(ref(speed)).alias("avg_speed"),
        F.max(ref(speed)).alias("max_speed"),
        F.avg(ref(angle)).alias("avg_angle"),
        F.avg(ref(distance)).alias("avg_distance"),
        F.max(ref(distance)).alias("max_distance"),
        F.count_if(ref(speed) >= hard).alias("hard_hits"),
    )
    qualified = board.where(F.col("batted_balls") >= minimum)
    return qualified.withColumn("hard_hit_share", F.col("hard_hits") / F.col("batted_balls"))


def expected_stats(pitches: DataFrame, by: Sequence[str] = ("batter",), minimum: int = 1) -> DataFrame:
    """Expected average and weighted on-base values per player, from plate appearances."""
    ended = pitches.where(ref("events").isNotNull())
    board = ended.groupBy(*refs(by)).agg(
        F.count(F.lit(1)).alias("pa"),
        F.avg("estimated_ba_using_speedangle").alias("est_ba"),
        F.avg("estimated_woba_using_speedangle").alias("est_woba"),
        (F.sum("woba_value") / F.nullif(F.sum("woba_denom"), F.lit(0.0))).alias("woba"),
    )
    return board.where(F.col("pa") >= minimum)


def arsenal_wide(
    pitches: DataFrame,
    kind: str = "avg_speed",
    by: Sequence[str] = ("pitcher",),
    minimum: int = 1,
    pitch: str = "pitch_type",
    speed: str = "release_speed",
    spin: str = "release_spin_rate",
    types: Sequence[str] = codes.PITCH_CODES,
    rest: str | None = None,
) -> DataFrame:
    """Pitch types as columns: mean speed, number of pitches, or mean spin.

    The code list is fixed, so one aggregate of conditional values does it. With
    ``rest`` a last column of that name takes the types outside the list.
    """
    kind = codes.choose(kind, codes.ARSENAL_TYPES, "kind")
    measure = {"avg_speed": ref(speed), "n_": F.lit(1), "avg_spin": ref(spin)}[kind]
    fold = F.count if kind == "n_" else F.avg

    def column(chosen: Column, name: str) -> Column:
        value = fold(F.when(chosen, measure))
        return (F.nullif(value, F.lit(0)) if kind == "n_" else value).alias(name)

    columns = [column(ref(pitch) == code, code) for code in types]
    if rest is not None:
        columns.append(column(~ref(pitch).isin(list(types)), rest))
    wide = pitches.groupBy(*refs(by)).agg(F.count(F.lit(1)).alias("_n"), *columns)
    return wide.where(F.col("_n") >= minimum).drop("_n")


def arsenal_stats(
    pitches: DataFrame,
    by: Sequence[str] = ("pitcher",),
    minimum: int = 1,
    pitch: str = "pitch_type",
    speed: str = "release_speed",
    value: str = "estimated_woba_using_speedangle",
) -> DataFrame:
    """Per player and pitch type: use, speed and result."""
    counts = pitches.groupBy(*refs(by), ref(pitch)).agg(
        F.count(F.lit(1)).alias("pitches"),
        F.avg(ref(speed)).alias("avg_speed"),
        F.avg(ref(value)).alias("avg_result"),
    )
    return share_within(counts, by, "pitches", "pitch_usage").where(F.col("pitches") >= minimum)


def movement(
    pitches: DataFrame,
    pitch_type: str = "FF",
    by: Sequence[str] = ("pitcher",),
    minimum: int = 1,
    pitch: str = "pitch_type",
    x: str = "pfx_x",
    z: str = "pfx_z",
) -> DataFrame:
    """Mean break of one pitch type per player."""
    board = pitches.where(ref(pitch) == pitch_type).groupBy(*refs(by)).agg(
        F.count(F.lit(1)).alias("pitches"),
        F.avg(ref(x)).alias("avg_break_x"),
        F.avg(ref(z)).alias("avg_break_z"),
    )
    return board.where(F.col("pitches") >= minimum)


def percentile_board(
    board: DataFrame,
    metrics: Sequence[str],
    by: Sequence[str] = ("year",),
    name: str = "player_name",
    player_id: str | None = "player_id",
) -> DataFrame:
    """0 to 100 rank of every metric within its season, real players only."""
    return percent_ranks_of(named_players(board, name, player_id), by, {m: f"{m}_percentile" for m in metrics}, scale=100.0)


def bat_tracking(pitches: DataFrame, by: Sequence[str] = ("batter",), minimum: int = 1) -> DataFrame:
    """Mean bat speed and swing length per player, over measured swings."""
    if not {"bat_speed", "swing_length"} <= set(pitches.columns):
        raise InvalidParameter("The pitch table has no bat_speed and swing_length columns.")
    board = pitches.where(F.col("bat_speed").isNotNull()).groupBy(*refs(by)).agg(
        F.count(F.lit(1)).alias("swings"),
        F.avg("bat_speed").alias("avg_bat_speed"),
        F.avg("swing_length").alias("avg_swing_length"),
    )
    return board.where(F.col("swings") >= minimum)


def spin_comparison(
    pitches: DataFrame,
    pitch_a: str = "FF",
    pitch_b: str = "CH",
    by: Sequence[str] = ("pitcher",),
    minimum: int = 1,
    pitch: str = "pitch_type",
    axis: str = "spin_axis",
) -> DataFrame:
    """Mean spin axis of two pitch types per player, both thrown often enough."""
    a, b = codes.pitch_code(pitch_a), codes.pitch_code(pitch_b)
    board = pitches.where(ref(pitch).isin(a, b)).groupBy(*refs(by)).agg(
        F.count_if(ref(pitch) == a).alias("n_a"),
        F.count_if(ref(pitch) == b).alias("n_b"),
        F.avg(F.when(ref(pitch) == a, ref(axis))).alias("axis_a"),
        F.avg(F.when(ref(pitch) == b, ref(axis))).alias("axis_b"),
    )
    both = board.where((F.col("n_a") >= minimum) & (F.col("n_b") >= minimum))
    return both.withColumn("axis_difference", F.col("axis_a") - F.col("axis_b"))


def park_factors(landed: DataFrame, venues: Sequence[int] | None = None) -> DataFrame:
    """Typed park factors under their public names, valid venues only."""
    named = rename_present(landed, schemas.PARK_FACTOR_NAMES)
    if "park_factor" in named.columns and "woba_factor" not in named.columns:
        named = named.withColumn("woba_factor", F.col("park_factor"))
    return at_venues(strict_table(named, schemas.PARK_FACTOR_REQUIRED, schemas.PARK_FACTOR), venues)


# Variants of the active-spin board, best first.
ACTIVE_SPIN_ORDER = ("spin-based", "observed")


def active_spin(landed: DataFrame, keys: Sequence[str] = ("year",), variant: str = "spin_type") -> DataFrame:
    """Per season, the rows of the best variant that has any; no variant for any season is an error."""
    order = F.array_position(F.array(*[F.lit(v) for v in ACTIVE_SPIN_ORDER]), ref(variant))
    known = require_rows(landed.where(ref(variant).isin(*ACTIVE_SPIN_ORDER)), "There are no active spin rows of any variant.")
    ordered = known.withColumn("_priority", order)
    return first_source(ordered, list(keys), "_priority").drop("_priority")


def season_stats(
    stats: DataFrame,
    seasons: tuple[int, int],
    counting: Sequence[str],
    by: Sequence[str],
    season: str = "season",
    split_seasons: bool = True,
    wanted: dict[str, Sequence] | None = None,
    bounds: dict[str, tuple] | None = None,
    qualify: tuple[str, float] | None = None,
) -> DataFrame:
    """Counting stats per player, or per team, over a range of seasons.

    ``split_seasons`` keeps one row per season; otherwise the range is added
    up. ``wanted`` and ``bounds`` restrict league, month, position, age and the
    like before, ``qualify`` is a minimum on a summed column after.
    """
    predicates = [ref(season).between(*seasons)]
    predicates += [ref(c).isin(list(values)) for c, values in (wanted or {}).items()]
    predicates += [ref(c).between(*pair) for c, pair in (bounds or {}).items()]
    keys = [*by, season] if split_seasons else list(by)
    board = stats.where(all_of(predicates)).groupBy(*refs(keys)).agg(
        *[F.sum(ref(c)).alias(c) for c in counting], F.count(F.lit(1)).alias("n_rows")
    )
    return board if qualify is None else board.where(ref(qualify[0]) >= qualify[1])


def stat_scope(
    category: str = "bat",
    league: str = "all",
    month: str | None = None,
    position: str = "all",
) -> dict[str, list]:
    """Checked codes of a season-stat query, as the ``wanted`` values of ``season_stats``.

    Columns are ``category``, ``league``, ``month`` (its number) and ``position``;
    ``all`` and no month restrict nothing.
    """
    wanted = {"category": [codes.choose(category, codes.STAT_CATEGORIES, "category")]}
    if (code := codes.choose(league, codes.LEAGUES, "league")) != "all":
        wanted["league"] = [code]
    if month is not None:
        wanted["month"] = [codes.MONTHS[codes.choose(month, tuple(codes.MONTHS), "month")]]
    if (code := codes.choose(position, codes.FIELD_POSITIONS, "position")) != "all":
        wanted["position"] = [code]
    return wanted


def standings(
    games: DataFrame,
    division: Sequence[str] = ("division",),
    team: str = "team",
    won: Column | None = None,
) -> DataFrame:
    """Wins, losses, share and games back from one row per team and game.

    The leader has the best share, then the most wins, then the first name.
    """
    won = ref("won") if won is None else won
    table = games.groupBy(*refs(division), ref(team)).agg(
        F.count_if(won).alias("W"), F.count_if(~won).alias("L")
    )
    shared = table.withColumn("W-L%", ref("W") / F.nullif(ref("W") + ref("L"), F.lit(0)))
    # The teams of a division are few once they are counted; the leader's record comes from a window over them.
    order = (F.coalesce(ref("W-L%"), F.lit(-1.0)).desc(), ref("W").desc(), ref(team).asc())
    teams = Window.partitionBy(*refs(division)).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lead_w, lead_l = F.first("W").over(teams), F.first("L").over(teams)
    return shared.withColumn("GB", ((lead_w - F.col("W")) + (F.col("L") - lead_l)) / 2)


def team_results(
    games: DataFrame,
    home: str = "home_team",
    away: str = "visiting_team",
    home_score: str = "home_score",
    away_score: str = "visiting_score",
) -> DataFrame:
    """Two rows per decided game, one for each side, from a game log.

    The sides are an array that is exploded, so the log is read once.
    """
    sides = F.array(
        F.struct(ref(home).alias("team"), (ref(home_score) > ref(away_score)).alias("won")),
        F.struct(ref(away).alias("team"), (ref(away_score) > ref(home_score)).alias("won")),
    )
    decided = games.where(ref(home_score) != ref(away_score))
    return decided.select("*", F.explode(sides).alias("_side")).select("*", "_side.team", "_side.won").drop("_side")


def regression_check(
    history: DataFrame,
    current: DataFrame,
    by: Sequence[str] = ("profile",),
    metric: str = "wall_time_seconds",
    sigma: float = REGRESSION_SIGMA,
) -> DataFrame:
    """Current value against the mean and deviation of its history.

    Fewer than two earlier values is never a regression; with no deviation the
    plain difference stands in for sigma.
    """
    past = history.where(ref(metric).isNotNull()).groupBy(*refs(by)).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(ref(metric)).alias("_mean"), F.stddev_samp(ref(metric)).alias("_std")
    )
    joined = current.join(past, list(by), "left")
    enough = F.coalesce(F.col("_n") >= 2, F.lit(False))
    mean = F.when(enough, F.col("_mean")).otherwise(ref(metric))
    std = F.when(enough, F.col("_std")).otherwise(F.lit(0.0))
    gap = ref(metric) - mean
    distance = F.when(std == 0, gap).otherwise(gap / F.nullif(std, F.lit(0.0)))
    return joined.select(
        *refs(by),
        ref(metric).alias("current_value"),
        mean.alias("baseline_mean"),
        std.alias("baseline_std"),
        distance.alias("sigma"),
        (distance > sigma).alias("is_regression"),
    )


def ratio_leaders(
    stats: DataFrame, by: Sequence[str], top_value: str, bottom_value: str, name: str, limit: int, digits: int = 2
) -> DataFrame:
    """Highest rounded ratios of two summed columns."""
    sums = stats.groupBy(*refs(by)).agg(F.sum(ref(top_value)).alias("_a"), F.sum(ref(bottom_value)).alias("_b"))
    scored = sums.select(*refs(by), clean.ratio(F.col("_a"), F.col("_b"), digits).alias(name))
    return scored.orderBy(F.desc_nulls_last(name), *refs(by)).limit(limit)
