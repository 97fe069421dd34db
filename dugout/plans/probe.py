"""Which kind of page is this? Probes, routing, and embedded JSON.

A kind has a name, the texts it needs, a predicate and an extraction. The first
kind whose predicate holds is used; a page no kind accepts goes to the rejects
with the diagnostics of every probe. Other kinds can be registered.
"""

from __future__ import annotations

import html as entities
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter
from dugout.functions import clean
from dugout.operators.names import once, ref, refs
from dugout.plans.flatten import LIST, OBJECT, field_at, is_object, parsed
from dugout.plans.tables import board_tables, csv_rows

# What the formats look like.
DATA_VARIABLE = "var data ="
DATA_PATTERN = r"(?s)var data = (\[.*?\]);"
NEXT_DATA_PATTERN = r'(?s)<script id="__NEXT_DATA__" type="application/json">(.*?)</script>'
NEXT_DATA_QUERIES = "props.pageProps.dehydratedState.queries"
LEADERS_KEY = "leaders/major-league/data"
INIT_STATE_PATTERN = r'(?s)<span[^>]*?data-init-state="([^"]*)"'
RANKING_QUERY = "getPlayerRankingsFromSelection"
TABLE_TAG = "<table"
GRADE_PATTERN = r"\b([A-Za-z0-9\-/\s]+)\s*:\s*(\d+)"
GRADES = (
    "overall", "hit", "power", "run", "arm", "field", "fastball", "slider", "curveball", "changeup",
    "cutter", "splitter", "control",
)


@dataclass(frozen=True)
class PageKind:
    """One way of reading a page."""

    name: str
    accepts: Callable[[Column], Column]
    needs: tuple[str, ...]
    extract: Callable[[DataFrame, Sequence[str], str], DataFrame]
    #: Whether an accepted page can be read; without it every accepted page is taken to be readable.
    readable: Callable[[Column], Column] | None = None


def csv_bodies(pages: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    """Rows of CSV bodies with a header, as maps."""
    return csv_rows(pages, keys, html, lambda c: F.nullif(clean.trim_text(c), F.lit("")))


def embedded_list(html: Column) -> Column:
    """Items of ``var data = [...];`` as JSON texts; null when there is no such list."""
    return F.from_json(F.regexp_extract(html, DATA_PATTERN, 1), LIST)


def embedded_json(pages: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    """Objects of ``var data = [...];`` as maps of text. A page without a readable list fails the job."""
    unreadable = F.raise_error(F.concat(F.lit("[embedded-json] cannot be read: "), F.left(ref(html), F.lit(200)))).cast(LIST)
    items = F.coalesce(embedded_list(ref(html)), unreadable)
    rows = pages.select(*refs(keys), F.posexplode(items).alias("row_index", "_item")).where(is_object(F.col("_item")))
    return rows.select(*refs(keys), "row_index", F.from_json("_item", OBJECT).alias("cells"))


CSV = PageKind(
    "csv",
    lambda text: ~F.startswith(text, F.lit("<")) & F.contains(text, F.lit(",")),
    (",",),
    csv_bodies,
)
EMBEDDED = PageKind(
    "embedded-json",
    lambda text: F.contains(text, F.lit(DATA_VARIABLE)),
    (DATA_VARIABLE,),
    embedded_json,
    lambda text: embedded_list(text).isNotNull(),
)
TABLE = PageKind("html-table", lambda text: F.contains(text, F.lit(TABLE_TAG)), (TABLE_TAG,), board_tables)
BOARD_KINDS = (CSV, EMBEDDED, TABLE)


def missing_texts(body: Column, needs: Sequence[str]) -> Column:
    """Needed texts that do not occur."""
    return F.filter(F.array(*[F.lit(n) for n in needs]), lambda n: ~F.contains(body, n))


def probed(pages: DataFrame, kinds: Sequence[PageKind] = BOARD_KINDS, html: str = "html") -> DataFrame:
    """Pages with the kind that reads them, null when none does, and diagnostics."""
    if not kinds:
        raise InvalidParameter("No page kinds are registered.")
    text = clean.trim_text(ref(html))
    chosen = F.coalesce(*[F.when(kind.accepts(text) & (text != ""), F.lit(kind.name)) for kind in kinds])
    reports = [
        F.concat(F.lit(f"[{kind.name}] missing: "), F.array_join(missing_texts(ref(html), kind.needs), " "))
        for kind in kinds
    ]
    return pages.withColumn("format", chosen).withColumn(
        "diagnostics", F.when(F.col("format").isNull(), F.concat_ws("\n", *reports))
    )


def read_pages(
    pages: DataFrame, keys: Sequence[str], kinds: Sequence[PageKind] = BOARD_KINDS, html: str = "html", fail: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows of all pages, each read by its kind, and the pages no kind accepts.

    A page that its kind accepts and then cannot read fails the job; with ``fail=False`` it is among
    the pages that are given back, with the kind as its diagnostics. It does not fall through to
    another kind.
    """
    marked = probed(pages, kinds, html)
    if not fail:
        broken = [F.when((F.col("format") == k.name) & ~k.readable(ref(html)), F.lit(f"[{k.name}] cannot be read")) for k in kinds if k.readable]
        told = F.coalesce(*broken, F.col("diagnostics"))
        marked = once(marked, _told=told).withColumn("diagnostics", F.col("_told")).drop("_told")
        marked = marked.withColumn("format", F.when(F.col("diagnostics").isNull(), F.col("format")))
    parts = [
        kind.extract(marked.where(F.col("format") == kind.name), keys, html)
        .select(*refs(keys), "row_index", "cells")
        .withColumn("format", F.lit(kind.name))
        for kind in kinds
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole, marked.where(F.col("format").isNull())


def leader_rows(pages: DataFrame, keys: Sequence[str], html: str = "html", fail: bool = True) -> DataFrame:
    """Player objects of a leaders page, as maps with tags stripped from text.

    They lie in the first query of the page state whose key names the leaders. A page without
    such a list fails the job; with ``fail=False`` it has no rows.
    """
    state = F.regexp_extract(ref(html), NEXT_DATA_PATTERN, 1)
    queries = pages.select(*refs(keys), parsed(state, {NEXT_DATA_QUERIES: LIST}).alias("_state"))
    read = F.transform(
        F.filter(field_at("_state", NEXT_DATA_QUERIES), is_object),
        lambda q: parsed(q, {"queryKey": LIST, "state.data.data": LIST}),
    )
    wanted = F.filter(read, lambda q: F.array_contains(q["queryKey"], LEADERS_KEY))
    first = queries.select(*refs(keys), F.try_element_at(wanted, F.lit(1)).alias("_query"))
    found = F.col("_query.state.data.data")
    if fail:
        found = F.coalesce(found, F.raise_error(F.lit(f"A page has no list of {LEADERS_KEY}.")).cast(LIST))
    players = first.select(*refs(keys), F.posexplode(found).alias("row_index", "_player"))
    cells = F.transform_values(F.from_json("_player", OBJECT), lambda k, v: clean.strip_tags(v))
    return players.where(is_object(F.col("_player"))).select(*refs(keys), "row_index", cells.alias("cells"))


def unreadable_leader_pages(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Pages that yield no player, by an anti-join on their keys."""
    return pages.join(leader_rows(pages, keys, html, fail=False).select(*refs(keys)).distinct(), list(keys), "left_anti")


def grade_pairs(text: Column) -> Column:
    """Scouting grades ``Hit: 60`` of a report as (key, value) structs in order."""
    plain = F.regexp_replace(text, clean.TAG_PATTERN, " ")
    names = F.regexp_extract_all(plain, F.lit(GRADE_PATTERN), 1)
    values = F.regexp_extract_all(plain, F.lit(GRADE_PATTERN), 2)
    return F.zip_with(
        names, values, lambda k, v: F.struct(F.lower(clean.trim_text(k)).alias("key"), v.try_cast("bigint").alias("value"))
    )


def grade(pairs: Column, key: str) -> Column:
    """The last value given for a key."""
    return F.try_element_at(F.filter(pairs, lambda p: p["key"] == key), F.lit(-1))["value"]


def init_state(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Page state held in an attribute, entities resolved, as JSON text ``body``."""
    raw = F.regexp_extract(ref(html), INIT_STATE_PATTERN, 1)
    return pages.select(*refs(keys), unescaped(raw).alias("body"))


def unescaped(text: Column) -> Column:
    """Text with all its character references resolved.

    Spark has no function for the two thousand named ones, so texts go through
    the standard library in Arrow batches.
    """

    @F.pandas_udf("string")
    def resolve(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else entities.unescape(t))

    return resolve(text)


def payload_entities(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entities of a page state: (keys, ref, value), the value as JSON text."""
    read = states.select(*refs(keys), parsed(F.col("body"), {"payload": OBJECT}).alias("_s"))
    return read.select(*refs(keys), F.explode("_s.payload").alias("ref", "value"))


# What is read of rankings, players, teams and levels.
ITEM_LEAVES = {
    "rank": "string",
    "playerEntity.player.__ref": "string",
    "playerEntity.position": "string",
    "playerEntity.eta": "string",
    "playerEntity.signed": "string",
    "playerEntity.prospectBio": "array<struct<contentText:string>>",
}
PLAYER_LEAVES = {
    name: "string"
    for name in (
        "id", "useName", "useLastName", "currentAge", "height", "weight", "batSideCode", "pitchHandCode",
        "birthDate", "birthCity", "birthCountry", "activeRoster.__ref",
    )
}
TEAM_LEAVES = {"name": "string", "parentOrgName": "string", "sport.__ref": "string"}
LEVEL_LEAVES = {"abbreviation": "string"}


def prospect_rankings(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Ranked prospects with identity, team, level and scouting grades.

    Rankings point to players, players to teams, teams to levels, all in the
    state of the same page.
    """
    state = init_state(pages, keys, html).select(*refs(keys), parsed(F.col("body"), {"payload": OBJECT}).alias("_s"))
    # The entities stay in the page's row, so that following a pointer is a look-up and no join.
    entities = once(state, _entities=F.col("_s.payload")).select(*refs(keys), "_entities")
    queries = F.map_entries(F.from_json(F.try_element_at("_entities", F.lit("ROOT_QUERY")), OBJECT))
    matching = F.filter(queries, lambda e: F.contains(e["key"], F.lit(RANKING_QUERY)))
    ranking = F.from_json(F.try_element_at(matching, F.lit(1))["value"], LIST)

    def named(text: Column, path: str) -> Column:
        return F.try_element_at(F.col("_entities"), F.get_json_object(text, path))

    def linked(text: Column) -> Column:
        player = named(text, "$.playerEntity.player.__ref")
        team = named(player, "$.activeRoster.__ref")
        level = named(team, "$.sport.__ref")
        return F.struct(text.alias("item"), player.alias("player"), team.alias("team"), level.alias("level"))

    # The texts a ranking names are looked up before its rows part, which then carry nothing else of the page.
    listed = F.transform(F.filter(ranking, is_object), linked)
    texts = entities.select(*refs(keys), F.explode(listed).alias("_t"))
    leaves = {"item": ITEM_LEAVES, "player": PLAYER_LEAVES, "team": TEAM_LEAVES, "level": LEVEL_LEAVES}
    whole = once(texts, **{name: parsed(F.col(f"_t.{name}"), wanted) for name, wanted in leaves.items()})
    report = F.try_element_at("item.playerEntity.prospectBio", F.lit(-1))["contentText"]
    graded = whole.withColumn("_grades", grade_pairs(F.coalesce(report, F.lit(""))))
    whole_number = lambda name: F.col(name).try_cast("bigint")
    return graded.select(
        *refs(keys),
        whole_number("item.rank").alias("rank"),
        whole_number("player.id").alias("player_id"),
        clean.trim_text(clean.full_name(F.col("player.useName"), F.col("player.useLastName"))).alias("name"),
        whole_number("player.currentAge").alias("age"),
        F.col("player.height").alias("height"),
        whole_number("player.weight").alias("weight"),
        F.col("player.batSideCode").alias("bats"),
        F.col("player.pitchHandCode").alias("throws"),
        F.col("player.birthDate").alias("birth_date"),
        clean.joined_text(F.col("player.birthCity"), F.col("player.birthCountry")).alias("birthplace"),
        F.col("item.playerEntity.position").alias("position"),
        F.col("team.name").alias("team"),
        F.col("team.parentOrgName").alias("organization"),
        F.col("level.abbreviation").alias("level"),
        F.col("item.playerEntity.eta").alias("eta"),
        F.col("item.playerEntity.signed").alias("signed"),
        *[grade(F.col("_grades"), key).alias(f"grade_{key}") for key in GRADES],
    )
