"""Cleaning functions on text built from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dugout.functions import clean, codes
from dugout.operators import typed
from dugout.plans.catalog.base import query, table
from dugout.sources.payloads import payload_key, query_params


def _pick(index, *values):
    """One of the given texts per row."""
    listed = F.array(*[F.lit(v).cast("string") if v is None or isinstance(v, str) else v for v in values])
    return F.get(listed, index.cast("int"))


_TOKENS = "[null, '', 'None', 'nan', '---', '---%', 'null', 'NaN', l_returnflag, ' none ']"


@query(f"""
with t as (select l_orderkey, l_linenumber, l_partkey, {_TOKENS}[(1 + l_partkey % 10)::int] as cell from lineitem)
select l_orderkey, l_linenumber, l_partkey,
       case when cell in ('---%', '---', '', 'None', 'nan', 'none', 'null') then null else cell end as exact,
       case when trim(cell) in ('', '---', '---%') or lower(trim(cell)) in ('nan', 'none', 'null') then null else trim(cell) end as loose
from t""")
def null_tokens(spark, folder):
    lines = table(spark, folder, "lineitem")
    cell = _pick(
        F.col("l_partkey") % 10,
        None, "", "None", "nan", "---", "---%", "null", "NaN", F.col("l_returnflag"), " none ",
    )
    text = lines.select("l_orderkey", "l_linenumber", "l_partkey", cell.alias("cell"))
    return text.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        clean.null_tokens(F.col("cell")).alias("exact"),
        clean.cell_text(F.col("cell")).alias("loose"),
    )


@query("""
select l_orderkey, l_linenumber, case l_linenumber % 3 when 0 then l_quantity::bigint / 100.0::double
       when 1 then l_quantity end as share
from lineitem""")
def percent_text(spark, folder):
    lines = table(spark, folder, "lineitem")
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    text = _pick(F.col("l_linenumber") % 3, F.concat(quantity, F.lit("%")), quantity, F.lit("abc"))
    return lines.select("l_orderkey", "l_linenumber", clean.percent_fraction(text).alias("share"))


@query("""
select o_orderkey, case when o_orderstatus = 'F' then null else floor(o_totalprice)::bigint end as whole from orders""")
def thousands_text(spark, folder):
    orders = table(spark, folder, "orders")
    grouped = F.format_number(F.floor("o_totalprice"), 0)
    text = F.when(F.col("o_orderstatus") == "F", F.concat(grouped, F.lit(".5"))).otherwise(grouped)
    return orders.select("o_orderkey", clean.thousands_int(text).alias("whole"))


@query("""
select l_orderkey, l_linenumber, l_partkey,
       case l_partkey % 7 when 0 then l_quantity when 1 then l_quantity + 0.5 end as number,
       case l_partkey % 7 when 0 then l_quantity::bigint when 1 then floor(l_quantity + 0.5)::bigint end as whole
from lineitem""")
def lenient_numbers(spark, folder):
    lines = table(spark, folder, "lineitem")
    whole = F.col("l_quantity").cast("bigint").cast("string")
    text = _pick(
        F.col("l_partkey") % 7,
        F.concat(F.lit(" "), whole, F.lit(" ")), F.concat(whole, F.lit(".5")), "true", "N/A", " NaN", "", "x1",
    )
    rows = lines.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("cell"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        clean.lenient_double(F.col("cell")).alias("number"),
        clean.lenient_int(F.col("cell")).alias("whole"),
    )


_STAT_CELLS = """
with t as (select o_orderkey, case when o_orderkey % 9 = 0 then '---' else (o_orderkey % 60)::varchar end as "HR",
                  case when o_orderkey % 4 = 0 then 'x' || o_orderkey else (o_orderkey % 1000)::varchar end as "Basic_AB",
                  case when o_orderkey % 5 = 0 then '12.5%' else '0.25' end as "Basic_OPS", o_orderstatus as "Tm" from orders)"""


def _stat_cells(spark, folder):
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 9 == 0, "---").otherwise((key % 60).cast("string")).alias("HR"),
        F.when(key % 4 == 0, F.concat(F.lit("x"), key.cast("string"))).otherwise((key % 1000).cast("string")).alias("Basic_AB"),
        F.when(key % 5 == 0, "12.5%").otherwise("0.25").alias("Basic_OPS"),
        F.col("o_orderstatus").alias("Tm"),
    )


@query(_STAT_CELLS + """
select 'HR' as column_name, count(*) as n_values, count(*) filter (try_cast("HR" as bigint) is null) as n_lost from t
union all select 'Basic_AB', count(*), count(*) filter (try_cast("Basic_AB" as bigint) is null) from t
union all select 'Basic_OPS', count(*), 0 from t""")
def strict_audit(spark, folder):
    cells = _stat_cells(spark, folder)
    return typed.cast_audit(cells, typed.stat_rules(cells))


@query(_STAT_CELLS + """
select o_orderkey, try_cast("HR" as bigint) as "HR",
       case when "Basic_OPS" like '%\\%' escape '\\' then replace("Basic_OPS", '%', '')::double / 100.0 else "Basic_OPS"::double end as "Basic_OPS",
       "Tm" from t""")
def stat_types(spark, folder):
    return typed.coerce_stats(_stat_cells(spark, folder).drop("Basic_AB"))


@query("""
select page_id, trim(regexp_replace(regexp_extract(html, '<body>(.*)</body>', 1, 's'), '<[^>]+>', '', 'g')) as body
from pages""")
def strip_tags(spark, folder):
    body = F.regexp_extract("html", "(?s)<body>(.*)</body>", 1)
    return table(spark, folder, "pages").select("page_id", clean.strip_tags(body).alias("body"))


@query("""
select page_id, case when contains(url, 'utm_source=') then split_part(url, 'utm_source=', -1) end as source from pages""")
def link_id(spark, folder):
    return table(spark, folder, "pages").select("page_id", clean.id_after(F.col("url"), "utm_source=").alias("source"))


@query("""
select c_custkey, trim(lower(c_name)) as lowered, coalesce(first, '') || ' ' || coalesce(last, '') as whole,
       trim(coalesce(first, '') || ', ' || coalesce(last, ''), ', ') as place, length(c_name) between 15 and 21 as near
from (select c_custkey, c_name, case when c_custkey % 3 = 0 then null else split_part(c_name, '#', 1) end as first,
             case when c_custkey % 4 = 0 then null else c_mktsegment end as last from customer)""")
def text_clean(spark, folder):
    key = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        "c_name",
        F.concat(F.lit(" \t"), F.upper("c_name"), F.lit("\n ")).alias("padded"),
        F.when(key % 3 != 0, F.substring_index("c_name", "#", 1)).alias("first"),
        F.when(key % 4 != 0, F.col("c_mktsegment")).alias("last"),
    )
    return rows.select(
        "c_custkey",
        F.lower(clean.trim_text(F.col("padded"))).alias("lowered"),
        clean.full_name(F.col("first"), F.col("last")).alias("whole"),
        clean.joined_text(F.col("first"), F.col("last")).alias("place"),
        clean.length_near(F.col("c_name"), 18, 3).alias("near"),
    )


@query("""
with t as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, o_orderkey % 5 as k, (o_orderkey % 9)::bigint as n,
                  (o_orderkey % 9000)::bigint as bits, o_orderpriority as p from orders)
select o_orderkey,
       case k when 0 then n when 1 then null when 2 then null when 3 then n else null end as batting_order,
       bits as url_bitrate,
       case k when 0 then (case when n = 4 then 4000 else n end) when 1 then n * 1000 when 2 then (case when bits = 4 then 4000 else bits end) else 0 end as label_bitrate,
       case k when 0 then p when 1 then 'Hit' when 2 then '[]' when 3 then 'single' else p end as event,
       case k when 0 then day::date when 1 then null when 2 then day::date when 3 then null else null end as day,
       coalesce(case k when 0 then p end, case k when 1 then day end) as present
from t""")
def label_parse(spark, folder):
    key = F.col("o_orderkey")
    k, n, bits = key % 5, (key % 9).cast("string"), (key % 9000).cast("string")
    day, priority = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority")
    text = F.lit
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        _pick(k, F.concat(text(" "), n), text("x"), text(""), n, None).alias("order_text"),
        F.concat(text("https://clips/a_"), bits, text("k.mp4")).alias("url"),
        _pick(k, F.concat(text("mp4 "), n, text("K")), F.concat(text("high "), n, text("m")), text(""), text("plain"), text("")).alias("label"),
        _pick(k, text("x"), text("x"), F.concat(text("v/"), bits, text("K.mp4")), text("x"), text("x")).alias("label_url"),
        _pick(
            k,
            F.concat(text("["), priority, text(", Hit, play]")),
            text("[out, Hit]"),
            text("[]"),
            text("single"),
            F.concat(text("[Out, "), priority, text("]")),
        ).alias("event_text"),
        _pick(k, F.concat(day, text("T10:00:00Z")), text("2024-13-01"), day, text("soon"), text("")).alias("day_text"),
        _pick(k, priority, None, None, None, None).alias("first"),
        _pick(k, None, day, None, None, None).alias("second"),
    )
    return rows.select(
        "o_orderkey",
        clean.batting_order(F.col("order_text")).alias("batting_order"),
        clean.url_bitrate(F.col("url")).cast("bigint").alias("url_bitrate"),
        clean.label_bitrate(F.col("label"), F.col("label_url")).alias("label_bitrate"),
        clean.event_kind(F.col("event_text")).alias("event"),
        clean.iso_date(F.col("day_text")).alias("day"),
        clean.first_present(F.col("first"), F.col("second")).alias("present"),
    )


@query("""
select page_id, regexp_extract(html, '<title>(.*?)</title>', 1) as title,
       strip_accents(regexp_extract(html, '<title>(.*?)</title>', 1)) as plain from pages""")
def accent_strip(spark, folder):
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return table(spark, folder, "pages").select("page_id", title.alias("title"), clean.strip_accents(title).alias("plain"))


@query("select doc_id, strip_accents(text) as plain from documents")
def accent_strip_texts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", clean.strip_accents(F.col("text")).alias("plain"))


@query("""
select l_orderkey, l_linenumber, l_partkey, round(degrees(atan2(l_quantity - 125.42, 198.27 - l_discount)), 6) as angle
from lineitem""")
def spray_angle(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(clean.spray_angle(F.col("l_quantity"), F.col("l_discount")), 6).alias("angle"),
    )


@query("""
select p_partkey, case p_partkey % 6 when 0 then '7' when 1 then '2' when 2 then '9' when 3 then '8' when 4 then 'IF' end as number
from part""")
def position_codes(spark, folder):
    spoken = _pick(F.col("p_partkey") % 6, "lf", "Catcher", "right field", "8", "IF", "nowhere")
    return table(spark, folder, "part").select("p_partkey", codes.position_number_column(spoken).alias("number"))


@query("""
select page_id, md5('1:' || split_part(url, '?', 1) || '?' || coalesce(array_to_string(list_sort(string_split(
         case when contains(url, '?') then split_part(split_part(url, '#', 1), '?', 2) end, '&')), '&'), '')) as payload_key
from pages""")
def payload_keys(spark, folder):
    base = F.substring_index("url", "?", 1)
    return table(spark, folder, "pages").select(
        "page_id", payload_key(base, query_params(F.col("url"))).alias("payload_key")
    )


@query("select doc_id, text from documents")
def decode_bytes(spark, folder):
    """Texts as bytes, those without other letters in Latin-1 where that is possible."""
    documents = table(spark, folder, "documents")
    latin = F.rlike("text", F.lit("^[\\x{0000}-\\x{00FF}]*$"))
    content = F.when(latin, F.encode(F.when(latin, F.col("text")), "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return documents.select("doc_id", clean.utf8_or_latin1(content).alias("text"))
