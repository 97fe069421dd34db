"""Clip search payloads: items with key/value fields and playback lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.functions import clean
from dugout.operators.names import once
from dugout.operators.ranks import best_item
from dugout.plans.flatten import LIST, is_object, parsed
from dugout.sources import schemas

# Field names by meaning.
PLAYER_ID_FIELDS = ("playerid", "player_id")
PLAYER_NAME_FIELDS = ("playername", "player_name")
EVENT_FIELDS = ("eventtype", "event_type", "hitresult", "event")
SPEED_FIELDS = ("exitvelocity", "exit_velocity", "launch_speed")
DISTANCE_FIELDS = ("hitdistance", "hit_distance", "launch_angle_distance")
# The clip URL that is built when no playback is listed.
CLIP_ROOT = "https://mlb-cuts-diamond.mlb.com/FORGE"
CLIP_WIDTH, CLIP_HEIGHT, CLIP_FPS, CLIP_BITRATE = 1280, 720, 59, clean.FOUR_K_BITRATE

# Where items may lie, and what is read of an item.
ITEM_PLACES = {
    "data.search.plays": LIST,
    "data.mediaPlayback": LIST,
    "plays": LIST,
    "highlights": LIST,
    "items": LIST,
}
ITEM_TEXTS = (
    "id", "content_id", "mediaPlaybackId", "gameDate", "date", "timestamp", "title", "headline",
    "blurb", "description", "player_id", "player_name", "player", "event_type", "event", "playbacks",
)
MEDIA_TEXTS = ("date", "mediaPlaybackId", "title", "blurb", "description", "playbacks")
FIELD_TYPE = "array<struct<name:string,value:string,displayValue:string>>"


def playback_list(raw: Column) -> Column:
    """Playbacks with a URL, as typed structs in their order; ``raw`` holds their texts."""
    names = ("name", "type", "url", "href", "bitrate", "width", "height")
    read = F.transform(F.filter(raw, is_object), lambda p: parsed(p, dict.fromkeys(names, "string")))
    some = lambda value: F.nullif(value, F.lit(""))
    named = F.transform(
        read,
        lambda p: F.struct(
            F.coalesce(some(p["name"]), some(p["type"]), F.lit("")).alias("name"),
            F.coalesce(some(p["url"]), some(p["href"])).alias("url"),
            F.nullif(p["bitrate"].try_cast("bigint"), F.lit(0).cast("bigint")).alias("given"),
            *[F.coalesce(p[side].try_cast("bigint"), F.lit(0).cast("bigint")).alias(side) for side in ("width", "height")],
        ),
    )
    return F.transform(
        F.filter(named, lambda p: p["url"].isNotNull()),
        lambda p: F.struct(
            p["name"].alias("name"),
            p["url"].alias("url"),
            F.coalesce(p["given"], clean.label_bitrate(p["name"], p["url"])).alias("bitrate"),
            p["width"].alias("width"),
            p["height"].alias("height"),
        ),
    )


def first_hls(playbacks: Column) -> Column:
    lists = F.filter(playbacks, lambda p: F.endswith(p["url"], F.lit(".m3u8")))
    return F.try_element_at(lists, F.lit(1))["url"]


def best_mp4(playbacks: Column) -> Column:
    """MP4 with the highest bitrate, the first on ties.

    A stream list counts as a file only by its label, and never the first one.
    """
    first_list = F.array_position(F.transform(playbacks, lambda p: F.endswith(p["url"], F.lit(".m3u8"))), True) - 1

    def playable(p: Column, i: Column) -> Column:
        return (i != first_list) & (F.endswith(p["url"], F.lit(".mp4")) | F.contains(F.lower(p["name"]), F.lit("mp4")))

    return best_item(F.filter(playbacks, playable), lambda p: p["bitrate"])["url"]


def clip_url(media: Column, day: Column) -> Column:
    """The file a clip is stored under, from its media ID and date."""
    name = F.concat(media, F.lit(f"_{CLIP_WIDTH}x{CLIP_HEIGHT}_{CLIP_FPS}_{CLIP_BITRATE}K.mp4"))
    return F.concat_ws("/", F.lit(CLIP_ROOT), F.date_format(day, "yyyy/yyyy-MM/dd"), name)


def _last(values: Column) -> Column:
    return F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(-1))


def _first_part(text: Column) -> Column:
    return clean.trim_text(F.substring_index(text, ",", 1))


def _values(names: tuple[str, ...], read) -> Column:
    named = F.filter("fields", lambda f: f["name"].isin(*names))
    return F.transform(named, read)


def _shown(f: Column) -> Column:
    return F.coalesce(F.nullif(f["shown"], F.lit("")), f["value"])


def _items(payloads: DataFrame, body: str) -> DataFrame:
    """Item texts; a search result decides alone, other places follow in order."""
    leaves = {**ITEM_PLACES, "data.search.total": "string"}
    read = once(payloads.select(body), doc=parsed(F.col(body), leaves))
    search = F.col("doc.data.search")
    others = F.coalesce("doc.data.mediaPlayback", "doc.plays", "doc.highlights", "doc.items")
    chosen = F.when(search.isNotNull(), search["plays"]).otherwise(others)
    return read.select(F.explode(chosen).alias("item")).where(is_object(F.col("item")))


def clips(payloads: DataFrame, body: str = "body") -> DataFrame:
    """One row per clip of any number of search payloads."""
    leaves = {**dict.fromkeys(ITEM_TEXTS, "string"), "mediaPlayback": "string", "fields": LIST}
    items = once(_items(payloads, body).withColumnRenamed("item", "_text"), item=parsed(F.col("_text"), leaves))
    first_media = F.try_element_at(F.from_json(F.col("item.mediaPlayback"), LIST), F.lit(1))
    both = once(items, mp=parsed(first_media, dict.fromkeys(MEDIA_TEXTS, "string")))

    def first(*places: str) -> Column:
        return F.coalesce(*[F.nullif(F.col(p), F.lit("")) for p in places])

    def playback_texts(place: str) -> Column:
        raw = F.col(place)
        inner = F.when(is_object(raw), parsed(raw, {"playbacks": LIST})["playbacks"]).otherwise(F.from_json(raw, LIST))
        return F.when(F.size(inner) > 0, inner)

    fields = F.transform(
        F.filter("item.fields", is_object),
        lambda f: parsed(f, dict.fromkeys(("name", "value", "displayValue"), "string")),
    )
    read = both.select(
        F.coalesce(first("item.id", "item.content_id", "item.mediaPlaybackId"), F.lit("")).alias("content_id"),
        clean.iso_date(first("item.gameDate", "mp.date", "item.date", "item.timestamp")).alias("date"),
        F.coalesce(first("mp.title", "item.title", "item.headline"), F.lit("")).alias("title"),
        F.coalesce(first("mp.blurb", "mp.description", "item.blurb", "item.description"), F.lit("")).alias("blurb"),
        first("mp.mediaPlaybackId", "item.mediaPlaybackId").alias("media"),
        *[F.col(f"item.{c}").alias(f"item_{c}") for c in ("player_id", "player_name", "player", "event_type", "event")],
        F.coalesce(fields, F.array().cast(FIELD_TYPE)).alias("raw_fields"),
        F.coalesce(
            playback_texts("item.playbacks"), playback_texts("mp.playbacks"), F.array().cast(LIST)
        ).alias("raw_playbacks"),
    )
    named = F.transform(
        "raw_fields",
        lambda f: F.struct(
            F.lower(F.coalesce(f["name"], F.lit(""))).alias("name"),
            F.coalesce(f["value"], F.lit("")).alias("value"),
            F.coalesce(f["displayValue"], F.lit("")).alias("shown"),
        ),
    )
    cleaned = once(read, fields=named, playbacks=playback_list(F.col("raw_playbacks")))
    shown_names = _values(PLAYER_ID_FIELDS, lambda f: F.nullif(_first_part(f["shown"]), F.lit("")))
    number = lambda names, kind: _last(_values(names, lambda f: clean.try_double(f["value"]).try_cast(kind)))
    listed = once(cleaned, listed=best_mp4(F.col("playbacks")), hls_url=first_hls(F.col("playbacks")))
    found = listed.select(
        "content_id",
        "date",
        "title",
        "blurb",
        F.coalesce(
            _last(_values(PLAYER_ID_FIELDS, lambda f: _first_part(f["value"]).try_cast("bigint"))),
            F.col("item_player_id").try_cast("bigint"),
        ).alias("player_id"),
        F.coalesce(
            _last(_values(PLAYER_NAME_FIELDS, _shown)),
            F.try_element_at(F.filter(shown_names, lambda v: v.isNotNull()), F.lit(1)),
            F.col("item_player_name"),
            F.col("item_player"),
        ).alias("player_name"),
        F.coalesce(
            clean.event_kind(_last(_values(EVENT_FIELDS, _shown))), F.col("item_event_type"), F.col("item_event")
        ).alias("event_type"),
        number(SPEED_FIELDS, "double").alias("exit_velocity"),
        number(DISTANCE_FIELDS, "bigint").alias("hit_distance"),
        "listed",
        "hls_url",
        "playbacks",
        F.when(F.col("media").isNotNull() & F.col("date").isNotNull(), clip_url(F.col("media"), F.col("date"))).alias("built"),
    )
    return _with_built_url(found)


def _with_built_url(found: DataFrame) -> DataFrame:
    """The built URL stands in where no file is listed, and joins the playbacks."""
    built = F.col("built")
    extra = F.struct(
        F.lit(f"mp4 {CLIP_BITRATE}K").alias("name"),
        built.alias("url"),
        F.lit(CLIP_BITRATE).cast("bigint").alias("bitrate"),
        F.lit(CLIP_WIDTH).cast("bigint").alias("width"),
        F.lit(CLIP_HEIGHT).cast("bigint").alias("height"),
    )
    needed = F.col("listed").isNull() & built.isNotNull() & ~F.exists("playbacks", lambda p: p["url"] == built)
    playbacks = F.when(needed, F.array_append("playbacks", extra)).otherwise(F.col("playbacks"))
    return found.select(
        "content_id", "date", "title", "blurb", "player_id", "player_name", "event_type", "exit_velocity",
        "hit_distance",
        F.coalesce("listed", "built").alias("best_mp4_url"),
        "hls_url",
        playbacks.cast(f"array<{schemas.PLAYBACK}>").alias("playbacks"),
    )
