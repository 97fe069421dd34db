"""Pages: links, HTML tables, embedded JSON, format probes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dugout.functions import clean
from dugout.plans import probe, tables
from dugout.plans.catalog.base import dealt, obj, query, table
from dugout.sources import html as H
from dugout.sources.payloads import split_rejected


def html(*parts) -> Column:
    """Text pieces and columns as one HTML text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query("""
with a as (select page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1, 'is')) as href,
                  unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2, 'is')) as text,
                  unnest(range(len(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1, 'is')))) as position from pages)
select page_id, position::int as position, href, trim(regexp_replace(text, '<[^>]+>', '', 'g')) as text from a""")
def html_rows(spark, folder):
    return H.page_links(table(spark, folder, "pages"), ["page_id"])


def _stat_pages(spark, folder):
    key = F.col("p_partkey")
    page = html(
        "<html><body><div class='x'><table class=\"stats_table\"><thead><tr><th colspan=2>Top</th></tr>",
        "<tr><th>#</th><th>Name</th><th>G</th><th></th><th>Tm &amp; Co</th></tr></thead><tbody>",
        "<tr><th>1</th><td><a href=\"/p/?mlb_ID=", key, "\">P ", key, "</a></td><td>",
        F.format_number(F.col("p_size") * 1000, 0), "</td><td>skip</td><td>---</td></tr>",
        "<tr><td>2<td>No link<td>", F.col("p_size"), "<td>skip<td>a<b>b</b>&eacute;",
        "</tbody></table></div><table><tr><th>other</th></tr></table></body></html>",
    )
    return dealt(table(spark, folder, "part")).select(key, page.alias("html"))


@query("""
select p_partkey, 'P ' || p_partkey as "Name", (p_size * 1000)::bigint as "G", null::varchar as tm, p_partkey::varchar as "mlbID" from part
union all select p_partkey, 'No link', p_size, 'abé', null from part""")
def html_stat_table(spark, folder):
    rows = tables.stat_tables(_stat_pages(spark, folder), ["p_partkey"])
    typed = tables.typed_stats(rows, ["Name", "G", "Tm & Co", "mlbID"], ["p_partkey"])
    return typed.withColumnRenamed("Tm & Co", "tm")


def _log_page() -> Column:
    key = F.col("c_custkey")
    row = lambda *cells: html("<tr>", *[p for c in cells for p in ("<td>", c, "</td>")], "</tr>")
    return html(
        '<table id="players_standard_pitching"><tr><th>no</th></tr></table>',
        '<table id="players_standard_batting"><thead><tr><th colspan="3"></th><th colspan="2">Basic</th></tr>',
        "<tr><th>Rk</th><th>Gtm</th><th>Unnamed: 3_level_1</th><th>AB</th><th>OPS</th></tr></thead><tbody>",
        row("1", key, F.when(key % 2 == 0, "@").otherwise(""), F.col("c_nationkey"), "0.5"),
        '<tr class="thead"><th>Rk</th><th>Gtm</th></tr>',
        row("2", "Gtm", "", "AB", "OPS"),
        row("3", key + 1, "", "---"),
        row("", "", "", "9999", "1.0"),
        "</tbody></table>",
    )


@query("""
select c_custkey, c_custkey as "Game", c_custkey % 2 != 0 as "Home", c_nationkey::bigint as "Basic_AB", 0.5::double as "Basic_OPS" from customer
union all select c_custkey, c_custkey + 1, true, null, null from customer""")
def html_game_log(spark, folder):
    pages = dealt(table(spark, folder, "customer")).select("c_custkey", _log_page().alias("html"))
    rows = tables.game_logs(pages, ["c_custkey"])
    return tables.typed_game_logs(rows, ["Game", "Home", "Basic_AB", "Basic_OPS"], ["c_custkey"])


@query("""
select c_custkey, 'Home' as "Split", 'Home or Away' as "Split Type", (c_custkey % 90 + 60)::double as "H", 20.0::double as "2B", 3.0::double as "3B",
       12.0::double as "HR", c_custkey % 90 + 60 - 20 - 3 - 12.0::double as "1B", c_custkey % 2 = 1 as is_level from customer where c_custkey % 2 = 0
union all select c_custkey, 'Home', 'By Level', (c_custkey % 90 + 60), 20, 3, 12, c_custkey % 90 + 25, true from customer where c_custkey % 2 = 1""")
def html_splits(spark, folder):
    key = F.col("c_custkey")
    splits = html(
        '<html><!-- plain --><!-- <div class="table_container"><table><caption>',
        F.when(key % 2 == 0, "Home or Away").otherwise("By Level"),
        "</caption><tr><th>Split</th><th>H</th><th>2B</th><th>3B</th><th>HR</th></tr>",
        "<tr><th>Split</th><td>H</td></tr><tr><th>Home</th><td>", key % 90 + 60, "</td><td>20</td><td>3</td><td>12</td></tr>",
        '</table></div><div class="table_container"><table><caption>By Inning</caption><tr><th>Split</th><th>H</th></tr>',
        "<tr><th>1st</th><td>4</td></tr></table></div> --></html>",
    )
    pages = dealt(table(spark, folder, "customer")).select("c_custkey", splits.alias("html"))
    rows = tables.splits(pages, ["c_custkey"])
    typed = tables.typed_splits(rows, ["Split", "H", "2B", "3B", "HR"], ["c_custkey", "is_level"])
    return typed.select("c_custkey", "Split", "Split Type", "H", "2B", "3B", "HR", "1B", "is_level")


@query("""
select c_custkey, c_mktsegment as "Position",
       case when c_custkey % 5 = 0 then '' when c_custkey % 2 = 0 then 'Right' else 'Left' end as "Bats",
       case when c_custkey % 5 = 0 then '' else 'Right' end as "Throws" from customer""")
def html_player_info(spark, folder):
    """Sides are only read where a paragraph gives both."""
    key = F.col("c_custkey")
    throws = F.when(key % 5 == 0, "").otherwise("• Throws: Right")
    bats = F.when(key % 2 == 0, "Right").otherwise("Left")
    box = html(
        '<div class="players"><p><strong>Position:</strong> ', F.col("c_mktsegment"), "</p><p>Bats: ", bats, " ", throws, "</p></div>"
    )
    pages = table(spark, folder, "customer").select("c_custkey", box.alias("html"))
    return tables.player_info(pages, ["c_custkey"]).select("c_custkey", "player_info.*")


@query("""
select p_partkey, '1' as "Rk", p_name as "Player", p_size::varchar as "HR", 0 as table_index from part
union all select p_partkey, '2', null, null, 0 from part union all select p_partkey, '10', p_brand, null, 1 from part""")
def html_all_tables(spark, folder):
    page = html(
        "<table><tr><td>Rk</td><td>Player</td><td>HR</td></tr><tr><td>1</td><td>", F.col("p_name"), "</td><td>", F.col("p_size"),
        "</td><td>beyond</td></tr><tr><td>2</td><td> </td></tr></table><table></table><table><thead><tr><th>Rk</th><th>Player</th></tr></thead><tbody><tr><td>10</td><td>",
        F.col("p_brand"), "</td></tr></tbody></table>",
    )
    pages = dealt(table(spark, folder, "part")).select("p_partkey", page.alias("html"))
    rows = tables.all_tables(pages, ["p_partkey"])
    wide = tables.wide(rows, ["Rk", "Player", "HR"], ["p_partkey", "table_index"])
    return wide.withColumn("table_index", F.when(F.col("table_index") > 0, 1).otherwise(0))


@query("""select p_partkey, '1' as "Rk", p_name as "Player" from part union all select p_partkey, '10', p_brand from part""")
def html_prospects(spark, folder):
    page = html(
        "<table><thead><tr><th>Rk</th><th>Player</th><th>Tm</th></tr></thead><tbody><tr><td>10</td><td>", F.col("p_brand"),
        "</td><td>x</td></tr><tr><td>1</td><td>", F.col("p_name"), "</td><td>y</td></tr></tbody></table>",
        "<table><tr><th>Rk</th></tr><tr><td>99</td></tr></table>",
    )
    pages = dealt(table(spark, folder, "part")).select("p_partkey", page.alias("html"))
    return tables.prospects(pages, ["p_partkey"], ["Rk", "Player", "Tm"], "batters")


@query("""
select s_suppkey, s_name || case when s_suppkey % 3 = 0 then ', Jr' else ', "Jr"' || chr(10) || 'of ' || s_nationkey end as "Name",
       case when s_suppkey % 2 = 0 then null else s_nationkey::varchar end as "HR" from supplier""")
def html_csv_block(spark, folder):
    key, name = F.col("s_suppkey"), F.concat("s_name", F.lit(", Jr"))
    homers = F.when(key % 2 == 0, "NULL").otherwise(F.col("s_nationkey").cast("string"))
    block = html('<table id="csv_x"><tr><th>Name</th><th>HR</th></tr><tr><td>', name, "</td><td>", homers, "</td></tr></table>")
    plain = html('<div class="csv">Name,HR\n"', F.col("s_name"), ', ""Jr""\nof ', F.col("s_nationkey"), '",', homers, "</div>")
    page = F.when(key % 3 == 0, block).otherwise(plain)
    return tables.wide(
        tables.csv_blocks(dealt(table(spark, folder, "supplier")).select("s_suppkey", page.alias("html")), ["s_suppkey"]),
        ["Name", "HR"],
        ["s_suppkey"],
    )


def _mixed_pages(spark, folder):
    """Landed bodies: CSV, embedded JSON, tables, and the raw pages in between."""
    key = F.col("page_id")
    csv = html('name,value\n"a, ""x""\r\nc",', key, "\n\nb,\n")
    script = html('<html><script>var data = [{"name": "a", "value": "', key, '"}];</script></html>')
    grid = html("<table><thead><tr><th>name</th><th>value</th></tr></thead><tbody><tr><td>a</td><td>", key, "</td></tr></tbody></table>")
    body = (
        F.when(key % 5 == 0, csv).when(key % 5 == 1, script).when(key % 5 == 2, grid).when(key % 5 == 3, "  ").otherwise(F.col("html"))
    )
    return table(spark, folder, "pages").select("page_id", body.alias("html"))


@query("""
select page_id, case page_id % 5 when 0 then 'csv' when 1 then 'embedded-json' when 2 then 'html-table' end as format from pages""")
def probe_format(spark, folder):
    return probe.probed(_mixed_pages(spark, folder)).select("page_id", "format")


@query("""
select page_id, 0 as row_index, case when page_id % 5 = 0 then 'a, "x"' || chr(13) || chr(10) || 'c' else 'a' end as name, page_id::varchar as value, case page_id % 5 when 0 then 'csv' when 1 then 'embedded-json' else 'html-table' end as format
from pages where page_id % 5 < 3
union all select page_id, 2, 'b', null, 'csv' from pages where page_id % 5 = 0""")
def read_by_format(spark, folder):
    rows, _ = probe.read_pages(_mixed_pages(spark, folder), ["page_id"])
    return tables.wide(rows, ["name", "value"], ["page_id", "row_index", "format"])


@query("""
select page_id, '[csv] missing: ' || case when page_id % 5 = 3 or not contains(html, ',') then ',' else '' end || chr(10) || '[embedded-json] missing: var data =' || chr(10) || '[html-table] missing: <table' as diagnostics
from pages where page_id % 5 >= 3""")
def probe_rejects(spark, folder):
    _, rejected = probe.read_pages(_mixed_pages(spark, folder), ["page_id"])
    return rejected.select("page_id", "diagnostics")


@query("""
select p_partkey, 0 as row_index, p_name as "Name", p_size::varchar as "HR" from part where p_partkey % 4 != 0
union all select p_partkey, 1, 'B & C', null from part where p_partkey % 4 != 0""")
def page_leaders(spark, folder):
    players = F.array(
        obj(Name=F.concat(F.lit("<a href='x'>"), F.col("p_name"), F.lit("</a> ")), HR=F.col("p_size")),
        obj(Name="<b>B & C</b>", HR=F.lit(None).cast("int")),
    )
    other = obj(queryKey=F.array(F.lit("menu")), state=obj(data=obj(data=F.slice(players, 1, 0))))
    wanted = obj(
        queryKey=F.array(F.when(F.col("p_partkey") % 4 != 0, "leaders/major-league/data").otherwise("else")),
        state=obj(data=obj(data=players)),
    )
    state = obj(props=obj(pageProps=obj(dehydratedState=obj(queries=F.array(other, wanted)))))
    page = html('<html><script id="__NEXT_DATA__" type="application/json">', F.to_json(state), "</script></html>")
    rows = probe.leader_rows(table(spark, folder, "part").select("p_partkey", page.alias("html")), ["p_partkey"], fail=False)
    return tables.wide(rows, ["Name", "HR"], ["p_partkey", "row_index"])


@query("""
select c_custkey, 1::bigint as rank, c_custkey as player_id, 'Jo ' || c_name as name, 'Town' as birthplace,
       case when c_custkey % 3 != 0 then 'Team ' || c_nationkey end as team, case when c_custkey % 3 != 0 then 'AA' end as level,
       60::bigint as grade_hit, (20 + c_custkey % 50)::bigint as grade_overall from customer""")
def page_rankings(spark, folder):
    key = F.col("c_custkey")
    report = html("<b>Scouting grades:</b> Hit: 60 | Overall: ", key % 50 + 20)
    item = obj(
        rank=1,
        playerEntity=obj(
            player=obj(__ref="Person:1"),
            prospectBio=F.array(obj(contentText=F.lit("Hit: 20")), obj(contentText=report)),
        ),
    )
    person = obj(
        id=key, useName="Jo", useLastName=F.col("c_name"), birthCity="Town",
        activeRoster=F.when(key % 3 != 0, obj(__ref="Team:9")),
    )
    payload = F.struct(
        F.struct(F.array(item).alias("getPlayerRankingsFromSelection(x)")).alias("ROOT_QUERY"),
        person.alias("Person:1"),
        obj(name=html("Team ", F.col("c_nationkey")), sport=obj(__ref="Sport:12")).alias("Team:9"),
        obj(abbreviation="AA").alias("Sport:12"),
    )
    escaped = F.replace(F.to_json(obj(payload=payload)), F.lit("&"), F.lit("&amp;"))
    state = F.replace(escaped, F.lit('"'), F.lit("&quot;"))
    page = html('<div><span class="a" data-init-state="', state, '"></span></div>')
    pages = table(spark, folder, "customer").select("c_custkey", page.alias("html"))
    found = probe.prospect_rankings(pages, ["c_custkey"])
    return found.select("c_custkey", "rank", "player_id", "name", "birthplace", "team", "level", "grade_hit", "grade_overall")


@query("""
select page_id, page_id % 6 = 0 as is_bad, case when page_id % 6 = 0 then 'Too many rows' end as reason from pages""")
def payload_quarantine(spark, folder):
    key = F.col("page_id")
    body = F.when(key % 6 == 0, "code,error\n7,Too many rows\n").otherwise(F.col("html"))
    good, bad = split_rejected(table(spark, folder, "pages").select("page_id", body.alias("body")))
    kept = good.select("page_id", F.lit(False).alias("is_bad"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(bad.select("page_id", F.lit(True).alias("is_bad"), clean.trim_text(F.col("reason")).alias("reason")))


@query("""
select page_id, page_id % 4 = 0 as is_bad, case when page_id % 4 = 0 then 'too "large", sorry' end as reason from pages""")
def rejected_payloads(spark, folder):
    """A table with an ``errors`` column is good, also with a comma in a heading; one headed ``error`` is not."""
    key = F.col("page_id")
    good_body = F.concat(F.lit("player_name,fielding_errors,year\nError,"), key.cast("string"), F.lit(",2024\n"))
    quoted = F.concat(F.lit('player,"hits,error",year\nx,'), key.cast("string"), F.lit(",2024\n"))
    body = F.when(key % 4 == 0, 'Error,code\r\n"too ""large"", sorry",7\r\n').when(key % 4 == 1, quoted).otherwise(good_body)
    good, bad = split_rejected(table(spark, folder, "pages").select("page_id", body.alias("body")))
    kept = good.select("page_id", F.lit(False).alias("is_bad"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(bad.select("page_id", F.lit(True).alias("is_bad"), "reason"))
