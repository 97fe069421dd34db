from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter, MissingPartition, PayloadRejected, SchemaMismatch
from dugout.operators.names import types_of
from dugout.sources import archive, files, payloads, pitches, schemas


def _write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_pitch_csv(spark, tmp_path):
    body = "game_date, game_pk,pitch_type,release_speed,note\n2026-06-01,1, SL ,85.5,\n2026-06-01,x,FF,fast, a\n"
    table = files.read_pitch_csv(spark, _write(tmp_path, "p.csv", body))
    assert types_of(table)["game_pk"] == "bigint" and types_of(table)["release_speed"] == "double"
    assert [tuple(r) for r in table.collect()] == [
        ("2026-06-01", 1, "SL", 85.5, None),
        ("2026-06-01", None, "FF", None, "a"),
    ]


@pytest.mark.parametrize(
    "body, rows",
    [
        ("player_id,year,stat\n1,2024,NaN\n2,2024,Infinity\n3,2024,1\n", 3),
        ("player_id,year,stat\n1,2024,2\n\n2,2024,3\n", 2),
        ("player_id,year,stat\n", 0),
    ],
)
def test_csv_edge_cases(spark, tmp_path, body, rows):
    table = files.read_pitch_csv(spark, _write(tmp_path, "e.csv", body))
    assert table.count() == rows and table.columns == ["player_id", "year", "stat"]


def test_positional_files(spark, tmp_path):
    log = ",".join(["20240401", "0", "Mon", "NYA", "AL", "1", "BOS", "AL", "1", "5", "3"])
    _write(tmp_path, "logs/gl.txt", log + "\n" + ",".join(str(i) for i in range(200)) + "\n")
    rows = files.read_game_logs(spark, str(tmp_path / "logs"), ["visiting_score"]).orderBy("visiting_score").collect()
    assert [r.visiting_score for r in rows] == [5, 9] and rows[1]["acquisition_info"] == "160"
    _write(tmp_path, "r/ANA2021.ROS", "ohtas001,Ohtani,Shohei,L,R,ANA,DH\n")
    _write(tmp_path, "r/NYA2021.ROS", "judga001,Judge,Aaron,R,R,NYA,OF\n")
    _write(tmp_path, "r/other.txt", "x,y\n")
    rosters = files.read_rosters(spark, str(tmp_path / "r"))
    assert {r.first_name for r in rosters.collect()} == {"Shohei", "Aaron"}
    parks = files.read_park_codes(spark, _write(tmp_path, "parks.csv", "PARKID,NAME\nALB01,Riverside\n"))
    assert parks.columns == ["park_id", "name"]


def test_event_files(spark, tmp_path):
    for name in ("2021NYA.EVA", "2021NYN.EVN", "2021AS.EVE", "2021WS.EVE", "TEAM2021"):
        _write(tmp_path, f"ev/{name}", b"id,\xe9\n" + name.encode())
    folder = str(tmp_path / "ev")
    regular = {r.filename: bytes(r.content) for r in files.read_event_files(spark, folder, 2021).collect()}
    assert set(regular) == {"2021NYA.EVA", "2021NYN.EVN"}
    assert regular["2021NYA.EVA"] == b"id,\xe9\n2021NYA.EVA"
    assert [r.filename for r in files.read_event_files(spark, folder, 2021, "asg").collect()] == ["2021AS.EVE"]
    assert types_of(files.read_event_files(spark, folder, 2021, "post")) == schemas.EVENT_FILE
    with pytest.raises(InvalidParameter):
        files.read_event_files(spark, folder, 2021, "spring")


def test_listing_and_required_rows(spark):
    df = spark.createDataFrame([('[{"name":"a.EVA"},{"name":"b.EVN"},{"size":1}]',), ('{"message":"no"}',)], "body string")
    assert sorted(r.name for r in files.listing(df).collect()) == ["a.EVA", "b.EVN"]
    with pytest.raises(PayloadRejected):
        files.require_rows(df.where("false"), "nothing listed")


def test_war_needs_its_columns(spark, tmp_path):
    path = _write(tmp_path, "w.csv", "name_common,mlb_ID\nA,1\n")
    with pytest.raises(SchemaMismatch, match="player_ID"):
        files.read_war(spark, path)


def test_archive(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "register.zip", "w") as z:
        z.writestr("r/data/people-0.csv", "id,name\n1,Mike\n2,\n")
        z.writestr("r/data/people-1.csv", "id,name\n3,Al\n")
        z.writestr("r/readme.md", "x")
    people = archive.unzip_members(spark, str(tmp_path / "register.zip"), r"/people.+csv$")
    assert people.count() == 2
    table = archive.csv_from_archive(spark, str(tmp_path / "register.zip"), r"/people-0.csv$", str(tmp_path / "landed"))
    assert {tuple(r) for r in table.collect()} == {(1, "Mike"), (2, None)}
    with pytest.raises(MissingPartition):
        archive.csv_from_archive(spark, str(tmp_path / "register.zip"), "teams", str(tmp_path / "none"))
    assert archive.table_file("batting_post") == "core/BattingPost.csv"
    assert archive.table_file("Teams") == "core/Teams.csv" and archive.table_file("teams_upstream") == "upstream/Teams.csv"
    with pytest.raises(InvalidParameter):
        archive.table_file("bowling")


def test_members_have_their_own_headers_and_quoted_breaks(spark, tmp_path):
    path = tmp_path / "two.zip"
    with zipfile.ZipFile(path, "w") as made:
        made.writestr("x/people-0.csv", 'id,name\n1,"a\nb"\n2,"c, ""d"""\n')
        made.writestr("x/people-1.csv", "name,id,more\ne,3,4.5\n")
        made.writestr("x/people-2.csv", "id,name\n")
    table = archive.csv_from_archive(spark, str(path), r"/people.+csv$", str(tmp_path / "landed"))
    assert sorted((r.id, r.name, r.more) for r in table.collect()) == [(1, "a\nb", None), (2, 'c, "d"', None), (3, "e", 4.5)]


def test_long_rows_are_refused_and_named(spark, tmp_path):
    (tmp_path / "s.csv").write_text("20240401,0,Mon\n" + ",".join("abcdefghijklm") + "\n")
    with pytest.raises(Exception, match="more than 12 cells"):
        files.read_schedules(spark, str(tmp_path / "s.csv")).collect()
    assert [r.date for r in files.long_rows(spark, str(tmp_path / "s.csv"), schemas.SCHEDULE_FILE).collect()] == ["a"]


def test_manifest_hash_ignores_order(spark):
    df = spark.range(50).withColumn("v", F.col("id") * 2)
    entries = archive.manifest([("a", "x", df), ("b", "y", df.orderBy(F.desc("id"))), ("c", "z", df.limit(49))]).collect()
    checks = {r.table_name: r.checksum for r in entries}
    assert checks["a"] == checks["b"] != checks["c"]


def test_payload_key_ignores_parameter_order(spark):
    row = spark.range(1).select(
        payloads.payload_key(F.lit("u"), F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))).alias("x"),
        payloads.payload_key(F.lit("u"), F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))).alias("y"),
        payloads.payload_key(F.lit("u"), F.create_map(F.lit("a"), F.lit("1"))).alias("z"),
    ).first()
    assert row.x == row.y != row.z


def test_rejected_payloads(spark):
    df = spark.createDataFrame([("error\nToo large\n",), ("a,b\n1,2",), ("a" * 250 + "error",), (None,)], "body string")
    good, bad = payloads.split_rejected(df)
    assert good.count() == 2
    assert {r.reason for r in bad.collect()} == {"Too large", None}
    tables = spark.createDataFrame([("player_name,fielding_errors,year\nA,1,2024",), ('code,"error"\n7,"Too, many"',)], "body string")
    good, bad = payloads.split_rejected(tables)
    assert good.first().body.startswith("player_name") and [r.reason for r in bad.collect()] == ["Too, many"]


def test_unreadable_files_are_named(spark, tmp_path):
    folder = tmp_path / "landed"
    row = spark.range(1).selectExpr("'p' as provider", "'u' as url", "map('a', 'b') as params", "timestamp'2024-01-01' as fetched_at", "'x' as body")
    row.coalesce(1).write.parquet(str(folder))
    row.limit(0).coalesce(1).write.mode("append").parquet(str(folder))
    (folder / "junk.parquet").write_bytes(b"no table at all, only some bytes")
    found = payloads.unreadable_files(spark, str(folder))
    assert [r.path.rsplit("/", 1)[1] for r in found.collect()] == ["junk.parquet"]
    assert len(found.inputFiles()) == 2 and len(list(folder.glob("*.parquet"))) == 3  # the one with a row is not opened
    assert payloads.read_landing(spark, str(folder), skip_unreadable=True).count() == 1
    with pytest.raises(Exception, match="junk|CANNOT_READ|FAILED_READ"):
        payloads.read_landing(spark, str(folder)).collect()


PITCHES = [
    ("FF", "2023-05-01", "A", 1, 95.1), ("SL", "2023-06-01", "B", 2, 85.0),
    ("FF", "2024-05-01", "A", 1, 96.0), ("CH", "2024-05-02", "C", 3, 84.0),
]


def _season_table(spark):
    return spark.createDataFrame(PITCHES, "pitch_type string, game_date string, player_name string, batter bigint, release_speed double")


def test_season_dataset(spark, tmp_path):
    root = str(tmp_path / "ds")
    assert pitches.stored_seasons(spark, root) == [] and pitches.scan_seasons(spark, root).count() == 0
    first = pitches.write_seasons(_season_table(spark), root, [2023])
    assert [(r.season, r.written) for r in first.collect()] == [(2023, True)]
    second = pitches.write_seasons(_season_table(spark).withColumn("release_speed", F.lit(0.0)), root, [2023, 2024])
    assert {(r.season, r.written) for r in second.collect()} == {(2023, False), (2024, True)}
    table = pitches.scan_seasons(spark, root)
    assert len(table.columns) == 90 and table.where("year = 2023 and release_speed > 0").count() == 2
    pitches.write_seasons(_season_table(spark).withColumn("release_speed", F.lit(1.0)), root, 2023, force=True)
    assert pitches.scan_seasons(spark, root, 2023).where("release_speed = 1.0").count() == 2
    assert pitches.scan_seasons(spark, root, [2024]).count() == 2
    with pytest.raises(MissingPartition, match="2022"):
        pitches.scan_seasons(spark, root, [2022, 2023])
    with pytest.raises(InvalidParameter):
        pitches.scan_seasons(spark, root, 1999)


def test_sparse_and_extra_columns(spark, tmp_path):
    root = str(tmp_path / "sparse")
    a = spark.createDataFrame([("5", "2023-05-01", "95.1")], "zone string, game_date string, release_speed string")
    b = spark.createDataFrame([(7, "2023-05-02", 70.5)], "zone int, game_date string, bat_speed double")
    pitches.write_chunks([a, b], root, [2023])
    row = pitches.scan_seasons(spark, root, 2023).orderBy("game_date").first()
    assert (row.zone, row.release_speed, row.pitch_type) == (5, 95.1, None)
    assert pitches.scan_seasons(spark, root, 2023, extras=True).where("bat_speed = 70.5").count() == 1


def test_date_ranges(spark):
    table = _season_table(spark).withColumn("home_team", F.lit("NYY")).withColumn("away_team", F.col("player_name"))
    rows = pitches.pitches_between(table, "2024-06-01", "2023-05-15")
    assert [r.game_date for r in rows.collect()] == ["2024-05-02", "2024-05-01", "2023-06-01"]
    assert pitches.pitches_between(table, "2023-01-01", "2024-12-31", team="C").count() == 1
    assert pitches.player_pitches(table, 1, "2023-01-01", "2024-12-31").count() == 2
    with pytest.raises(InvalidParameter):
        pitches.player_pitches(table, None)
    winter = table.withColumn("game_date", F.lit("2024-01-05"))
    assert pitches.pitches_between(winter, "2024-01-01", "2024-01-31").count() == 0


def test_pitch_order_puts_nulls_first(spark):
    df = spark.createDataFrame([("2024-01-01", 1), (None, 2), ("2024-01-02", 3)], "game_date string, game_pk int")
    assert [r.game_pk for r in pitches.sort_pitches(df).collect()] == [2, 3, 1]


def test_shared_folder_rule(spark, monkeypatch):
    from dugout import session

    assert session.shared_folder(spark) == spark.conf.get(session.CHECKPOINT_KEY)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_rows_without_a_date_are_not_lost_in_silence(spark, tmp_path):
    root = str(tmp_path / "ds")
    odd = _season_table(spark).unionByName(spark.createDataFrame([("FF", "soon", "A", 1, 9.0), ("FF", None, "B", 1, 9.0)], _season_table(spark).schema))
    with pytest.raises(SchemaMismatch, match="game_date"):
        pitches.write_seasons(odd, root, [2023, 2024])
    assert pitches.season_rejects(odd).count() == 2
    report = pitches.write_seasons(odd, root, [2022, 2023, 2024], undated="drop")
    assert {r.season: r.written for r in report.collect()} == {2022: False, 2023: True, 2024: True}
    later = _season_table(spark).where("game_date >= '2024'")
    again = pitches.write_seasons(later, root, [2023, 2024], force=True)
    assert {r.season: r.written for r in again.collect()} == {2023: False, 2024: True}
    assert pitches.stored_seasons(spark, root) == [2024]


def test_a_season_write_reads_the_landed_table_once(spark, tmp_path):
    landed = str(tmp_path / "landed")
    rows = [(f"{2019 + i % 3}-05-01", i) for i in range(30)]
    spark.createDataFrame(rows, "game_date string, game_pk long").write.parquet(landed)
    reads = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        reads.add(1)
        return x

    watched = spark.read.parquet(landed).withColumn("game_pk", seen.asNondeterministic()("game_pk"))
    root = str(tmp_path / "pitches")
    kinds = {"game_date": "date", "game_pk": "bigint"}
    report = pitches.write_seasons(watched, root, [2019, 2020, 2022], types=kinds, last=2024).collect()
    assert [(r.season, r.written) for r in report] == [(2019, True), (2020, True), (2022, False)]
    assert reads.value == 30
    assert pitches.stored_seasons(spark, root) == [2019, 2020]


def test_an_undated_row_leaves_the_stored_seasons_as_they_were(spark, tmp_path):
    root = str(tmp_path / "pitches")
    kinds = {"game_date": "date", "game_pk": "bigint"}
    good = spark.createDataFrame([("2020-05-01", 1)], "game_date string, game_pk long")
    pitches.write_seasons(good, root, [2020], types=kinds, last=2024)
    bad = good.union(spark.createDataFrame([("soon", 2), ("2020-06-01", 3)], good.schema))
    with pytest.raises(SchemaMismatch, match="no readable game_date: soon"):
        pitches.write_seasons(bad, root, [2020], force=True, types=kinds, last=2024)
    assert [r.game_pk for r in pitches.scan_seasons(spark, root, [2020], types=kinds, last=2024).collect()] == [1]
    pitches.write_seasons(bad, root, [2020], force=True, types=kinds, last=2024, undated="drop")
    assert sorted(r.game_pk for r in pitches.scan_seasons(spark, root, [2020], types=kinds, last=2024).collect()) == [1, 3]


def test_folders_without_files_are_an_error(spark, tmp_path):
    (tmp_path / "other.txt").write_text("x")
    with pytest.raises(MissingPartition, match="no roster files"):
        files.read_rosters(spark, str(tmp_path))
    with pytest.raises(PayloadRejected, match="no regular event files"):
        files.read_event_files(spark, str(tmp_path), 2020)
    nothing = spark.createDataFrame([("[]",)], "body string")
    assert files.listing(nothing).count() == 0
    with pytest.raises(PayloadRejected, match="names no file"):
        files.listing(nothing, required=True)
