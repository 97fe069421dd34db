"""Not-modified revisit records of a web archive, resolved to the response they confirm.

A revisit says that a page had not changed since an earlier capture. It is joined
as of its date: by canonical address, with the latest full response that is
strictly earlier. Validators that both carry must agree; then the response's
headers, brought up to date by those that a not-modified answer may change, and
its payload stand for the revisit.

The as-of step looks at distinct (address, date) pairs, cut into ranges of dates:
each range finds its own latest response, and one row per address and range
carries the latest of the ranges before. An address with a third of all records is
spread over all ranges, and records of one instant are one pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import stored

NOT_MODIFIED = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"
#: Headers that a not-modified answer brings up to date, in lower case.
UPDATED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't select content.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"
#: Ranges of dates.
RANGES = 64


def canonical(uri: Column) -> Column:
    """Address without scheme, user, ``www.``, default port, fragment and tracking parameters; parameters sorted.

    Host in lower case; an empty path is ``/``. Null for what has no host.
    """
    plain = F.regexp_replace(F.trim(uri), "#.*$", "")
    host = F.lower(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r"^www\.", ""), ":(80|443)?$", "")
    path = F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    query = F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    whole = F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))
    return F.when(host != "", whole)


def _validator(headers: Column, name: str) -> Column:
    """A header to compare; the mark of a weak entity tag doesn't count."""
    return F.regexp_replace(F.trim(F.try_element_at(headers, F.lit(name))), "^W/", "")


def _agree(a: Column, b: Column, name: str) -> Column:
    return F.coalesce(_validator(a, name) == _validator(b, name), F.lit(True))


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers with those of the revisit that may change; names in lower case are expected."""
    fresh = F.map_filter(F.coalesce(revisit, F.create_map().cast("map<string,string>")), lambda k, _: k.isin(*UPDATED))
    old = F.map_filter(response, lambda k, _: ~F.array_contains(F.map_keys(fresh), k))
    return F.map_concat(old, fresh)


def resolve(records: DataFrame, carry: tuple[str, ...] = ("payload_digest",)) -> DataFrame:
    """One row per revisit record.

    ``records`` has ``record_id``, ``type`` (``response``, ``revisit`` or others,
    which are left out), ``uri``, ``date`` (timestamp), ``headers`` (map) and the
    columns of ``carry``, which the response hands over. Returns ``record_id``,
    ``uri``, ``date``, ``response_id``, ``status``, ``headers`` and ``carry``.

    ``status`` is ``resolved``; ``changed`` if the latest earlier response has
    another validator; ``no response`` if there is none, or if address or date
    cannot be read. Only resolved rows carry headers and payload columns. Of
    several responses of an address at one instant the one with the largest id
    counts, and a repeated id counts once. Repeated revisits stay; other columns
    are not carried.
    """
    slim = records.select("record_id", "type", "uri", "date", F.col("headers"), *carry, canonical(F.col("uri")).alias("site"))
    slim = stored(slim.filter(F.col("type").isin("response", "revisit")), "records")
    timed = slim.filter("site is not null and date is not null").withColumn("at", F.unix_micros("date"))
    pairs = timed.groupBy("site", "at").agg(F.max(F.when(F.col("type") == "response", F.col("record_id"))).alias("id"))

    cuts = timed.select(F.percentile_approx("at", [i / RANGES for i in range(1, RANGES)])).first()[0] or []
    below = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<bigint>")
    ranged = stored(pairs.withColumn("range", F.size(F.filter(below, lambda c: c < F.col("at")))), "pairs")
    own = Window.partitionBy("site", "range").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("site").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    response = F.when(F.col("id").isNotNull(), F.struct("at", "id"))
    lasts = ranged.groupBy("site", "range").agg(F.max(response).alias("last"))  # a row per address and range
    lasts = lasts.select("site", "range", F.max("last").over(earlier).alias("carried"))
    found = ranged.withColumn("near", F.max(response).over(own)).join(lasts, ["site", "range"])
    found = found.select("site", "at", F.coalesce("near", "carried")["id"].alias("response_id"))

    responses = slim.filter("type = 'response'").dropDuplicates(["record_id"])
    responses = responses.select(F.col("record_id").alias("response_id"), F.col("headers").alias("old"), *[F.col(c).alias(f"old_{c}") for c in carry])
    revisits = slim.filter("type = 'revisit'").select("record_id", "uri", "date", "headers", "site", F.unix_micros("date").alias("at"))
    both = revisits.join(found, ["site", "at"], "left").join(responses, "response_id", "left")
    agree = _agree(F.col("old"), F.col("headers"), "etag") & _agree(F.col("old"), F.col("headers"), "last-modified")
    status = F.when(F.col("response_id").isNull(), "no response").when(agree, "resolved").otherwise("changed")
    both = both.withColumn("status", status)
    done = F.col("status") == "resolved"
    return both.select(
        "record_id",
        "uri",
        "date",
        "response_id",
        "status",
        F.when(done, merged_headers(F.coalesce("old", F.create_map().cast("map<string,string>")), F.col("headers"))).alias("headers"),
        *[F.when(done, F.col(f"old_{c}")).alias(c) for c in carry],
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Captures as a crawler would have made them of a table of pages (``page_id``, ``url``, ``html``).

    Every page is fetched, polled again under another spelling of its address, and
    changes now and then; with each page the crawler also asks for the host's
    ``robots.txt``, so that a common host is a common address.
    """
    base = pages.select(
        "page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"), F.length(F.coalesce("html", F.lit(""))).cast("bigint").alias("size")
    )
    tag = lambda digest: F.concat(F.lit('"'), F.substring(digest, 1, 8), F.lit('"'))
    later = F.md5(F.concat(F.col("digest"), F.lit("-2")))
    changes = F.col("page_id") % 3 == 0
    spelled = F.when(F.col("page_id") % 2 == 0, F.concat("url", F.lit("#part"))).otherwise(
        F.concat("url", F.when(F.contains("url", F.lit("?")) | F.contains("url", F.lit("#")), F.lit("")).otherwise(F.lit("?utm_source=poll")))
    )
    robots = F.concat(F.regexp_extract("url", "^([^:]+://[^/?#]*)", 1), F.lit("/robots.txt"))
    current = F.when(changes, tag(later)).otherwise(tag(F.col("digest")))

    def record(k, kind, uri, offset, etag, digest, age):
        return F.struct(
            (F.col("page_id") * 10 + k).alias("record_id"),
            F.when(kind, F.lit("response")).otherwise(F.lit("revisit")).alias("type"),
            uri.alias("uri"),
            F.timestamp_seconds(F.lit(1_600_000_000) + F.col("page_id") * 10 + offset).alias("date"),
            F.create_map(F.lit("etag"), etag, F.lit("cache-control"), F.lit(f"max-age={age}"), F.lit("content-type"), F.lit(f"text/html; v={k}")).alias("headers"),
            F.when(kind, digest).alias("payload_digest"),
            F.when(kind, F.col("size")).alias("payload_size"),
        )

    url, digest = F.col("url"), F.col("digest")
    always, never = F.lit(True), F.lit(False)
    captures = F.array(
        record(0, always, url, 0, tag(digest), digest, 60),
        record(1, never, spelled, 100_000, tag(digest), digest, 120),
        record(2, changes, url, 200_000, F.when(changes, tag(later)).otherwise(F.concat(F.lit("W/"), tag(digest))), later, 180),
        record(3, never, url, 300_000, F.when(F.col("page_id") % 5 == 0, F.lit('"other"')).otherwise(current), digest, 240),
        record(4, never, url, -50, tag(digest), digest, 300),
        record(5, F.col("page_id") % 50 == 0, robots, 0, F.lit('"robots"'), F.md5(robots), 360),
    )
    return base.select(F.explode(captures).alias("r")).select("r.*")
