"""HTML and embedded payloads on small literals."""

from __future__ import annotations

import csv
import io
import json
import time

import pytest
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter, PayloadRejected
from dugout.plans import probe, tables
from dugout.sources import html as H


def pages(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page int, html string")


def cells(df):
    return [r.cells for r in df.orderBy("page", "row_index").collect()]


def test_stat_table(spark):
    body = (
        "<table><thead><tr><th>#</th><th>Name</th><th>G</th><th></th></tr></thead><tbody>"
        '<tr><th>1</th><td><a href="/x?mlb_ID=660271">Shohei&nbsp;Ohtani</a></td><td>1,158</td><td>?</td></tr>'
        "<tr><th>2</th><td>---</td><td>9</td></tr></tbody></table><table><tr><td>second</td></tr></table>"
    )
    rows = tables.stat_tables(pages(spark, body, "<p>no table</p>"), ["page"])
    assert cells(rows)[0] == {"Name": "Shohei\xa0Ohtani", "G": "1,158", "mlbID": "660271"}
    full = body.replace("<td>?</td>", "").replace("<th></th>", "")
    typed = tables.typed_stats(tables.stat_tables(pages(spark, full), ["page"]), ["Name", "G", "mlbID"], ["page"])
    assert [(r.Name, r.G, r.mlbID) for r in typed.orderBy("G").collect()] == [(None, 9, None), ("Shohei\xa0Ohtani", 1158, "660271")]


def test_game_log(spark):
    body = (
        '<table id="players_standard_batting"><thead><tr><th colspan="2"></th><th colspan="2">Basic</th></tr>'
        "<tr><th>Rk</th><th>Gtm</th><th>AB</th><th>OPS</th></tr></thead><tbody>"
        '<tr><td>1</td><td>3</td><td>4</td><td>.900</td></tr><tr class="thead"><td>Rk</td></tr>'
        "<tr><td>2</td><td>5</td><td>{}</td></tr><tr><td></td><td></td><td>9</td><td>9</td></tr></tbody></table>"
    )
    good = tables.typed_game_logs(tables.game_logs(pages(spark, body.format("")), ["page"]), ["Game", "Basic_AB", "Basic_OPS"])
    assert sorted(map(tuple, good.collect()), key=str) == [(3, 4, 0.9), (5, None, None)]
    bad = tables.typed_game_logs(tables.game_logs(pages(spark, body.format("not_a_number")), ["page"]), ["Game", "Basic_AB"])
    with pytest.raises(Exception, match="failed strict cast"):
        bad.collect()


def test_splits_in_comments(spark):
    table = (
        '<div class="table_container"><table><caption>{}</caption><tr><th>Split</th><th>H</th><th>2B</th><th>3B</th><th>HR</th></tr>'
        "<tr><th>Split</th><td>H</td></tr><tr><th>Home</th><td>9</td><td>2</td><td>1</td><td>3</td></tr></table></div>"
    )
    body = "<html><!-- " + table.format("Home or Away") + table.format("By Inning") + table.format("Top Level") + " --></html>"
    rows = tables.splits(pages(spark, body), ["page"])
    assert sorted((r.split_type, r.is_level) for r in rows.collect()) == [("Home or Away", False), ("Top Level", True)]
    typed = tables.typed_splits(rows.where("not is_level"), ["Split", "H", "2B", "3B", "HR"]).first()
    assert (typed["Split Type"], typed["H"], typed["1B"]) == ("Home or Away", 9.0, 3.0)
    info = '<div class="players"><p><strong>Position:</strong> Centerfielder</p><p>Bats: Right • Throws: Right</p></div>'
    assert tuple(tables.player_info(pages(spark, info), ["page"]).first().player_info) == ("Centerfielder", "Right", "Right")


@pytest.mark.parametrize(
    "shape",
    ['<div class="table_container"><caption>{c}</caption><table>{t}</table></div>', '<div class="table_container"><table>{t}</table><caption>{c}</caption></div>',
     '<div class="table_container"><div><caption>no</caption></div><table><caption>{c}</caption>{t}</table></div>'],
)
def test_split_captions_anywhere_in_the_container(spark, shape):
    rows = "<tr><th>Split</th><th>H</th></tr><tr><th>{}</th><td>9</td></tr>"
    made = "".join(shape.format(c=c, t=rows.format(i)) for i, c in enumerate(("Home or Away", "By Inning", "Top Level")))
    found = tables.splits(pages(spark, f"<html><!-- {made} --></html>"), ["page"]).collect()
    assert sorted((r.split_type, r.is_level, r.cells["Split"]) for r in found) == [("Home or Away", False, "0"), ("Top Level", True, "2")]


def test_all_character_references_are_resolved(spark):
    from dugout.plans.probe import unescaped

    df = spark.createDataFrame([("Jos&eacute; &amp;amp; &#x27;x&#39;&nbsp;",), (None,)], "t string")
    assert [r[0] for r in df.select(unescaped(F.col("t"))).collect()] == ["José &amp; 'x'\xa0", None]


def test_tables_come_in_several_batches(spark, monkeypatch):
    from dugout.sources import html

    monkeypatch.setattr(html, "PAGES_AT_ONCE", 7)
    df = spark.range(200).selectExpr("id as page", "concat('<table><tr><td>', id, '</td></tr></table>') as html").coalesce(1)
    assert html.page_tables(df, ["page"]).select("page").distinct().count() == 200


def test_generic_tables(spark):
    body = "<table><tr><th>Rk</th><th>Player</th></tr><tr><td>10</td><td>A</td><td>extra</td></tr><tr><td>2</td></tr></table><table></table>"
    rows = tables.all_tables(pages(spark, body), ["page"])
    assert cells(rows) == [{"Rk": "10", "Player": "A"}, {"Rk": "2", "Player": None}]
    assert tables.cell_names(rows) == ["Player", "Rk"]
    ranked = tables.prospects(pages(spark, body), ["page"], ["Rk", "Player"])
    assert [r.Rk for r in ranked.collect()] == ["10", "2"]
    assert [r.Rk for r in tables.prospects(pages(spark, body), ["page"], ["Rk"], numeric_rank=True).collect()] == ["2", "10"]
    with pytest.raises(PayloadRejected, match="pitchers"):
        tables.prospects(pages(spark, body), ["page"], ["Rk"], "pitchers")


def test_nested_and_broken_tables():
    found = H._scan("<script>'<table>'</script><table id=a><tr><td>1<td>x &lt; <i>y</i><tr><td><table id=b><tr><td>in</table></table><!-- <b> -->")
    assert [t["table_id"] for t in found] == ["a", "b"]
    texts = [[c[1].strip() for c in row["cells"]] for row in found[0]["rows"]]
    assert texts[0] == ["1", "x < y"] and "in" in texts[1][0]


def test_captions_at_any_depth_of_a_container():
    table = "<table><tr><th>Split</th></tr></table>"
    inside = '<div class="table_container"><div class="head"><h2><caption>By <b>Month</b></caption></h2></div><div class="wrap">' + table + "</div></div>"
    after = '<div class="table_container">' + table + "<div><caption>Late</caption></div></div>"
    own = '<div class="table_container"><div><caption>first</caption><caption>second</caption></div><table><caption>own</caption></table></div>'
    found = H._scan(inside + after + own + "<div class='x'>" + table + "</div>")
    assert [(t["container"], t["caption"]) for t in found] == [("table_container", "By Month"), ("table_container", "Late"), ("table_container", "own"), ("x", None)]


def test_probe_chain(spark):
    data = '<script>var data = [{"name": "A", "hr": 3}];</script>'
    grid = "<table><thead><tr><th>name</th></tr></thead><tbody><tr><td>B</td></tr></tbody></table>"
    df = pages(spark, 'name,hr\n"Judge, Aaron",58\n', data, grid, "plain text", "  ")
    rows, rejected = probe.read_pages(df, ["page"])
    assert {(r.page, r.format, r.cells.get("name")) for r in rows.collect()} == {
        (0, "csv", "Judge, Aaron"), (1, "embedded-json", "A"), (2, "html-table", "B"),
    }
    assert {r.page for r in rejected.collect()} == {3, 4}
    assert "[html-table] missing: <table" in rejected.where("page = 3").first().diagnostics
    with pytest.raises(InvalidParameter):
        probe.probed(df, [])


def test_a_kind_that_accepts_does_not_fall_through(spark):
    broken = pages(spark, "<p>var data = broken</p><table><tr><th>a</th></tr><tr><td>1</td></tr></table>")
    rows, rejected = probe.read_pages(broken, ["page"])
    with pytest.raises(Exception, match="embedded-json. cannot be read"):
        rows.collect()
    assert rejected.count() == 0
    rows, rejected = probe.read_pages(broken, ["page"], fail=False)
    assert rows.count() == 0 and [r.diagnostics for r in rejected.collect()] == ["[embedded-json] cannot be read"]


def test_boards_without_headers_and_pages_without_leaders_fail(spark):
    with pytest.raises(Exception, match="no headers"):
        tables.board_tables(pages(spark, "<table><tr><td>1</td></tr></table>"), ["page"]).collect()
    with pytest.raises(Exception, match="no list of leaders"):
        probe.leader_rows(pages(spark, "<html></html>"), ["page"]).collect()


CSV_TEXTS = [
    'a,b\n"x\ny",1\n', 'a,b\r\n"x, ""q""",2\r\n\r\n3,4', 'a,b\n,\n"",""\n', 'a,b\n"open, 1\n2', 'a\n"x"\n" y "\n', "a,b\n5\" pipe,2\n",
    'a,b\n"""",1\n', "a,b,c\n1\n1,2,3,4\n", 'a,"b\nc"\n1,2\n',
]


def test_csv_records_are_those_of_the_standard_library(spark):
    found = tables.csv_rows(pages(spark, *CSV_TEXTS), ["page"], "html", lambda c: c).collect()
    for i, text in enumerate(CSV_TEXTS):
        head, *rest = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
        want = [{k: (r[j].strip() if j < len(r) else None) for j, k in enumerate(head)} for r in rest]
        assert [{k: v and v.strip() for k, v in r.cells.items()} for r in found if r.page == i] == want, text


def test_csv_in_a_cell_takes_linear_time(spark):
    line = '"' + "a, " * 200_000 + '",' + "x," * 200_000 + '"' + 'q""' * 200_000 + '"'
    started = time.monotonic()
    row = tables.csv_rows(pages(spark, f"h\n{line}\n"), ["page"], "html", lambda c: c).first()
    assert row.cells["h"] == ("a, " * 200_000).strip() or row.cells["h"].startswith("a, ")
    assert time.monotonic() - started < 60


def test_csv_blocks(spark):
    block = '<table id="csv_x"><tr><th>Name</th><th>HR</th></tr><tr><td>Judge, Aaron</td><td>NULL</td></tr></table>'
    plain = '<div class="csv">Name,HR\n"Soto, Juan",41\n</div>'
    found = cells(tables.csv_blocks(pages(spark, block, plain, "<p></p>"), ["page"]))
    assert found == [{"Name": "Judge, Aaron", "HR": None}, {"Name": "Soto, Juan", "HR": "41"}]


def test_leaders_page(spark):
    queries = [
        {"queryKey": ["menu"], "state": {"data": {"data": [{"Name": "no"}]}}},
        {"queryKey": ["x", "leaders/major-league/data"], "state": {"data": {"data": [{"Name": "<a>Aaron Judge</a>", "HR": 58}]}}},
    ]
    state = json.dumps({"props": {"pageProps": {"dehydratedState": {"queries": queries}}}})
    good = f'<script id="__NEXT_DATA__" type="application/json">{state}</script>'
    df = pages(spark, good, "<html></html>")
    assert cells(probe.leader_rows(df, ["page"], fail=False)) == [{"Name": "Aaron Judge", "HR": "58"}]
    assert [r.page for r in probe.unreadable_leader_pages(df, ["page"]).collect()] == [1]


def test_rankings_page(spark):
    bio = [{"contentText": "Hit: 20"}, {"contentText": "<b>Hit:</b> 55 | Power: 60 | Arm: x | Hit: 65"}]
    payload = {
        "ROOT_QUERY": {"getPlayerRankingsFromSelection(a)": [
            {"rank": 1, "playerEntity": {"player": {"__ref": "P:1"}, "prospectBio": bio, "position": "SS"}},
            {"rank": 2, "playerEntity": {"player": {"__ref": "P:9"}}},
        ]},
        "P:1": {"id": 7, "useName": "Jo", "useLastName": "Ho", "birthCity": "", "birthCountry": "USA", "activeRoster": {"__ref": "T:1"}},
        "T:1": {"name": "Aces", "parentOrgName": "Org", "sport": {"__ref": "S:1"}},
        "S:1": {"abbreviation": "AAA"},
    }
    state = json.dumps({"payload": payload}).replace("&", "&amp;").replace('"', "&quot;")
    found = {r["rank"]: r for r in probe.prospect_rankings(pages(spark, f'<span data-init-state="{state}"></span>'), ["page"]).collect()}
    one = found[1]
    assert (one.name, one.birthplace, one.team, one.level, one.grade_hit, one.grade_power, one.grade_arm) == (
        "Jo Ho", "USA", "Aces", "AAA", 65, 60, None,
    )
    assert found[2].player_id is None and found[2].team is None
