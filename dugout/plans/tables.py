"""Plans for HTML pages: stat tables, game logs, splits, boards, CSV blocks.

Each returns one row per table row with a ``cells`` map, whose columns depend on
the page. ``wide`` turns the map into declared columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.functions import clean
from dugout.operators import records
from dugout.operators.align import pick_table
from dugout.operators.names import ref, refs
from dugout.operators.typed import coerce_stats, drop_named_like, with_singles
from dugout.sources import html as H

# Fixed values.
RANK_HEADERS = ("", "#", "Rk")
PLAYER_LINK = "mlb_ID="
PLAYER_COLUMN = "mlbID"
GAME_LOG_TABLE = "players_standard_"
GAME_LOG_NAMES = {
    "Gtm": "Game",
    "Unnamed: 3_level_1": "Home",
    "#": "NumPlayers",
    "Opp. Starter (GmeSc)": "OppStart",
    "Pitchers Used (Rest-GameScore-Dec)": "PitchersUsed",
}
LEVEL_SUFFIX = "Level"
INNING_SPLIT = "By Inning"
SPLIT_TEXT = ("Split", "Split Type")
CSV_TABLE_PREFIX = "csv_"
CSV_DIV_PATTERN = r'(?is)<div class="csv">(.*?)</div>'
PLAYER_DIV_PATTERN = r'(?is)<div class="players">(.*?)</div>'
BULLET = "•"


def wide(rows: DataFrame, columns: Iterable[str], keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns out of the ``cells`` map."""
    return rows.select(*refs(keep), *[F.try_element_at("cells", F.lit(c)).alias(c) for c in columns])


def cell_names(rows: DataFrame) -> list[str]:
    """Distinct column names, for callers that do not know them: one aggregate over names only."""
    names = rows.select(F.explode(F.map_keys("cells")).alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


def stat_tables(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """First table of each page, rank column dropped, player ID from links.

    The ID is one more cell after a row's own, under one more header.
    """
    first = H.page_tables(pages, keys, html).where("origin = 'page' and table_index = 0")
    heads = first.withColumn("_titles", H.last_header(F.col("rows"))["heads"])
    ranked = F.coalesce(F.try_element_at("_titles", F.lit(1)).isin(*RANK_HEADERS), F.lit(False))
    marked = heads.withColumn("_skip", ranked.cast("int"))
    body = F.filter(H.body_rows(F.col("rows")), lambda r: F.size(r["texts"]) > 0)
    with_ids = F.transform(
        body, lambda r: F.struct(F.concat(H.tail(r["texts"], F.col("_skip")), F.array(_player(r["links"]))).alias("texts"))
    )
    head = F.array_append(H.tail(F.col("_titles"), F.col("_skip")), F.lit(PLAYER_COLUMN))
    return H.paired_rows(marked, keys, head, with_ids, lambda r: r["texts"], clean.cell_text)


def _player(links: Column) -> Column:
    hits = F.filter(links, lambda a: F.contains(a, F.lit(PLAYER_LINK)))
    return F.coalesce(clean.id_after(F.try_element_at(hits, F.lit(1)), PLAYER_LINK), F.lit(""))


def typed_stats(rows: DataFrame, columns: Iterable[str], keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns with name-rule types; unreadable values fail the job."""
    return coerce_stats(wide(rows, columns, keep))


def _spread(row: Column) -> Column:
    """Header texts, each repeated over the columns it spans."""
    return F.flatten(F.zip_with(row["texts"], row["spans"], lambda c, n: F.array_repeat(c, F.greatest(n, F.lit(0)))))


def _log_names(tables: DataFrame) -> DataFrame:
    """One name per column from up to two header rows, as ``_head``."""
    heads = H.in_part(F.col("rows"), "thead")
    spread = tables.withColumns(
        {
            "_levels": F.size(heads),
            "_upper": _spread(F.try_element_at(heads, F.lit(1))),
            "_lower": _spread(F.try_element_at(heads, F.lit(2))),
        }
    )
    names = F.create_map(*[F.lit(x) for pair in GAME_LOG_NAMES.items() for x in pair])
    renamed = lambda c: F.coalesce(F.try_element_at(names, c), c)

    def joined(top: Column, sub: Column) -> Column:
        top, sub = F.coalesce(top, F.lit("")), renamed(F.coalesce(sub, F.lit("")))
        alone = (top == "") | F.contains(top, F.lit("Unnamed"))
        return F.when(alone, sub).otherwise(F.concat(top, F.lit("_"), sub))

    flat = F.when(F.col("_levels") == 1, F.transform("_upper", renamed)).otherwise(F.zip_with("_upper", "_lower", joined))
    return spread.withColumn("_names", flat)


def game_logs(pages: DataFrame, keys: Sequence[str], kind: str = "batting", html: str = "html") -> DataFrame:
    """Game log rows: flattened headers, totals line and repeated headers dropped.

    The totals line is the last row of the table, which is one array, so it is
    cut off before the rows are exploded.
    """
    tables = H.page_tables(pages, keys, html).where(F.col("table_id") == GAME_LOG_TABLE + kind)
    body = H.in_part(F.col("rows"), "tbody")
    chosen = F.when(F.size(body) > 0, body).otherwise(F.col("rows"))
    real = lambda r: (F.coalesce(r["css"], F.lit("")) != "thead") & (F.size(r["texts"]) > 0)
    kept = _log_names(tables).withColumn("_kept", F.filter(chosen, real))
    without_total = F.slice("_kept", F.lit(1), F.greatest(F.size("_kept") - 1, F.lit(0)))
    rows = H.paired_rows(kept, keys, F.col("_names"), without_total, lambda r: r["texts"], clean.null_tokens)
    game = F.try_element_at("cells", F.lit("Game"))
    repeated = F.map_contains_key("cells", "Game") & (game.isNull() | (game == "Gtm"))
    return rows.where(~repeated).withColumn("cells", F.map_filter("cells", lambda k, v: k != "Rk"))


def typed_game_logs(rows: DataFrame, columns: Iterable[str], keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns; ``Home`` is true where the cell was empty."""
    table = wide(rows, columns, keep)
    flagged = table.withColumn("Home", F.col("Home").isNull()) if "Home" in table.columns else table
    return coerce_stats(flagged)


def splits(pages: DataFrame, keys: Sequence[str], career: bool = False, html: str = "html") -> DataFrame:
    """Rows of split tables, which lie inside comments.

    ``is_level`` marks tables whose caption ends in ``Level``. Career pages
    carry one more leading header, whose column is a ``th`` cell.
    """
    commented = H.page_tables(pages, keys, html).where((F.col("origin") == "comment") & (F.col("container") == H.TABLE_CONTAINER))
    captioned = commented.withColumn("split_type", clean.trim_text(F.coalesce("caption", F.lit(""))))
    head = H.tail(F.try_element_at("rows", F.lit(1))["heads"], int(career))
    first = lambda r: F.coalesce(F.try_element_at(r["heads"], F.lit(1)), F.lit(""))
    real = F.filter(H.tail(F.col("rows")), lambda r: first(r) != "Split")
    cells = (lambda r: r["datas"]) if career else (lambda r: r["texts"])
    wanted = captioned.where(F.col("split_type") != INNING_SPLIT)
    rows = H.paired_rows(wanted, [*keys, "table_index", "split_type"], head, real, cells, lambda c: c)
    return rows.withColumn("is_level", F.endswith("split_type", F.lit(LEVEL_SUFFIX)))


def typed_splits(rows: DataFrame, columns: Iterable[str], keep: Sequence[str] = (), pitching: bool = False) -> DataFrame:
    """Declared columns; all but the split itself as numbers, singles added for batters."""
    named = wide(rows, columns, [*keep, "split_type"]).withColumnRenamed("split_type", "Split Type")
    table = named.where(ref("Split") != "Split") if "Split" in named.columns else named
    text = {*SPLIT_TEXT, *keep}
    typed = table.select([ref(c) if c in text else ref(c).try_cast("double").alias(c) for c in table.columns])
    return typed if pitching else with_singles(typed)


def player_info(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Position, batting and throwing side from the player box of a page."""
    box = F.regexp_extract(ref(html), PLAYER_DIV_PATTERN, 1)
    paragraphs = F.transform(F.regexp_extract_all(box, F.lit(r"(?is)<p[^>]*>(.*?)</p>"), 1), clean.strip_tags)
    position = F.try_element_at(F.filter(paragraphs, lambda p: F.startswith(p, F.lit("Position:"))), F.lit(-1))
    sides = F.filter(paragraphs, lambda p: F.contains(p, F.lit("Bats:")) & F.contains(p, F.lit("Throws:")))
    parts = F.split(F.try_element_at(sides, F.lit(-1)), BULLET)

    def labelled(values: Column, label: str) -> Column:
        hit = F.try_element_at(F.filter(values, lambda v: F.contains(v, F.lit(label))), F.lit(-1))
        return F.coalesce(clean.trim_text(F.replace(hit, F.lit(label), F.lit(""))), F.lit(""))

    info = F.struct(
        F.coalesce(clean.trim_text(F.replace(position, F.lit("Position:"), F.lit(""))), F.lit("")).alias("Position"),
        labelled(parts, "Bats:").alias("Bats"),
        labelled(parts, "Throws:").alias("Throws"),
    )
    return pages.select(*refs(keys), info.alias("player_info"))


def board_tables(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """First table of a leaderboard page as text; ``td`` cells only. A table without headers fails the job."""
    first = H.page_tables(pages, keys, html).where("origin = 'page' and table_index = 0")
    titles = H.last_header(F.col("rows"))["heads"]
    head = F.when(F.size(titles) > 0, titles).otherwise(F.raise_error(F.lit("A leaderboard table has no headers.")))
    return H.paired_rows(first, keys, head, H.body_rows(F.col("rows")), lambda r: r["datas"], lambda c: c)


def all_tables(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Rows of every table as text: padded or cut to the header, empty as null."""
    tables = H.page_tables(pages, keys, html).where("origin = 'page'")
    head = H.last_header(F.col("rows"))["texts"]
    empty = lambda c: F.nullif(c, F.lit(""))
    return H.paired_rows(tables, [*keys, "table_index"], head, H.body_rows(F.col("rows")), lambda r: r["texts"], empty)


def prospects(
    pages: DataFrame,
    keys: Sequence[str],
    columns: Iterable[str],
    player_type: str | None = None,
    numeric_rank: bool = False,
) -> DataFrame:
    """Ranked prospects of a team page, team columns dropped, by rank.

    The rank is text, so 10 comes before 2 unless ``numeric_rank`` is asked for.
    A sort reads its rows twice, once to find its ranges; the shuffle before it keeps the pages from
    being parsed twice.
    """
    rows = pick_table(all_tables(pages, keys), player_type)
    table = drop_named_like(wide(rows, columns, keys), ("Tm", "Unnamed"))
    return table.hint("rebalance").orderBy(ref("Rk").try_cast("bigint") if numeric_rank else ref("Rk"))


def csv_blocks(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Rows of an embedded CSV block: the first ``csv_`` table, or else a ``csv`` div."""
    marker = f'id="{CSV_TABLE_PREFIX}'
    has_table = F.contains(ref(html), F.lit(marker))
    firsts = H.page_tables(pages.where(has_table), keys, html, CSV_TABLE_PREFIX)
    filled = firsts.withColumn("_filled", F.filter("rows", lambda r: F.size(r["texts"]) > 0))
    head = F.try_element_at("_filled", F.lit(1))["texts"]
    tabled = H.paired_rows(filled, keys, head, H.tail(F.col("_filled")), lambda r: r["texts"], _csv_null)
    text = clean.strip_tags(F.regexp_extract(ref(html), CSV_DIV_PATTERN, 1))
    blocks = pages.where(~has_table).select(*refs(keys), text.alias("_text")).where("_text != ''")
    return tabled.unionByName(csv_rows(blocks, keys, "_text", _csv_null))


def _csv_null(cell: Column) -> Column:
    return F.nullif(F.nullif(cell, F.lit("NULL")), F.lit(""))


def csv_rows(bodies: DataFrame, keys: Sequence[str], text: str, null_rule) -> DataFrame:
    """Rows of CSV texts with a header record, as maps; quoted cells may hold commas and line breaks."""
    trimmed = bodies.select(*refs(keys), clean.trim_text(ref(text)).alias("_text"))
    parts = records.with_records(trimmed, "_text")
    head = F.transform(F.try_element_at("_records", F.lit(1)), records.bare)
    blank = lambda r: (F.size(r) == 1) & (clean.trim_text(F.get(r, F.lit(0))) == "")
    values = lambda r: F.when(blank(r), F.array().cast("array<string>")).otherwise(F.transform(r, records.bare))
    return H.paired_rows(parts, keys, head, H.tail(F.col("_records")), values, null_rule)
