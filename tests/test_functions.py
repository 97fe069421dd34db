from __future__ import annotations

import math
import unicodedata
from datetime import date

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter
from dugout.functions import clean, codes


def test_null_tokens_match_exactly(column):
    values = ["---%", "---", "", "None", "nan", "none", "null", "NaN", " ", "5", None]
    assert column(clean.null_tokens, values) == [None] * 7 + ["NaN", " ", "5", None]


def test_cell_text_matches_any_case_after_trimming(column):
    assert column(clean.cell_text, [" NULL ", "nAn", "---", "--", "\t a b\n", "\xa0x"]) == [None, None, None, "--", "a b", "x"]


def test_percent_and_thousands(column):
    assert column(clean.percent_fraction, ["12.5%", "7", "x%", "", None]) == [0.125, 7.0, None, None, None]
    assert column(clean.thousands_int, ["1,234", "1,2,3", "1.5", "a"]) == [1234, 123, None, None]


def test_lenient_numbers(column):
    texts = ["95.1", " 5 ", "N/A", "na", "NaN", "", "true", "1e3", "x", None]
    assert column(clean.lenient_double, texts) == [95.1, 5.0, None, None, None, None, None, 1000.0, None, None]
    assert column(clean.lenient_int, ["30.0", "-2.7", "nan", "abc"]) == [30, -2, None, None]


def test_strict_double_fails_on_text(column):
    rule = lambda c: clean.strict_double(c, clean.GAMES_BACK_NULLS)
    assert column(rule, ["-", "--", "Tied", "12.5", ".623"]) == [None, None, None, 12.5, 0.623]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(rule, ["soon"])


def test_tags_links_and_labels(column):
    assert column(clean.strip_tags, ["<a href='x'>Judge</a> ", "a<b>c</b>"]) == ["Judge", "ac"]
    assert column(lambda c: clean.id_after(c, "mlb_ID="), ["/p?mlb_ID=1&mlb_ID=22", "/p"]) == ["22", None]
    assert column(clean.url_bitrate, ["a_2500k.mp4", "a.mp4"]) == [2500, 0]
    label = lambda c: clean.label_bitrate(c, F.lit("v_1200K.mp4"))
    assert column(label, ["mp4 4K", "hi 8M", "600k"]) == [4000, 1200, 600]
    assert column(lambda c: clean.label_bitrate(c, F.lit("v.mp4")), ["hi 8M", "plain"]) == [8000, 0]


def test_event_kind(column):
    texts = ["[Hit, Home Run]", "[Home Run, hit]", "[out, play]", "[]", "single"]
    assert column(clean.event_kind, texts) == ["Home Run", "Home Run", "play", "[]", "single"]


def test_iso_date(column):
    texts = ["2024-04-01T00:00:00Z", "2024-02-30", "2024-13-01", "soon", "", None]
    assert column(clean.iso_date, texts) == [date(2024, 4, 1), None, None, None, None, None]


def test_names_and_ids(spark, column):
    assert column(clean.name_key, ["Red Sox", "D-backs"]) == ["redsox", "dbacks"]
    assert column(clean.id_or_sentinel, [5, None], "bigint") == [5, -1]
    row = spark.range(1).select(
        clean.full_name(F.lit("Mike"), F.lit(None)).alias("a"),
        clean.joined_text(F.lit(None), F.lit("Cuba")).alias("b"),
        clean.joined_text(F.lit("Havana"), F.lit("Cuba")).alias("c"),
        clean.ratio(F.lit(1.0), F.lit(0.0)).alias("d"),
        clean.spray_angle(F.lit(125.42), F.lit(98.27)).alias("e"),
    )
    a, b, c, d, e = row.first()
    assert (a, b, c, d, e) == ("Mike ", "Cuba", "Havana, Cuba", None, 0.0)


def test_accents(column):
    words = ["Acuña", "Valenzuéla", "Ronald", "Jiří Ťok", "é", "ß", "Ώ", None]
    assert column(clean.strip_accents, words) == ["Acuna", "Valenzuela", "Ronald", "Jiri Tok", "e", "ß", "Ω", None]


@given(st.text(alphabet=st.characters(min_codepoint=0x20, max_codepoint=0x24F), max_size=20))
def test_accents_follow_decomposition(text):
    plain = "".join(c for c in unicodedata.normalize("NFD", text) if not 0x300 <= ord(c) <= 0x36F)
    assert clean.strip_accents_text(text) == plain


def test_bytes_are_utf8_or_latin1(spark):
    rows = spark.createDataFrame([("é".encode(),), ("é".encode("latin-1"),)], "b binary")
    assert [r[0] for r in rows.select(clean.utf8_or_latin1(F.col("b"))).collect()] == ["é", "é"]


def test_codes(column):
    assert codes.pitch_code("sinker") == "SI" and codes.pitch_code("Curveball") == "CU"
    assert codes.pitch_name("ff") == "4-Seamer"
    assert codes.position_number("Left Field") == "7" and codes.position_number("all") == ""
    assert codes.position_number(3) == "3" and codes.position_word("SS") == "shortstop"
    assert codes.choose("40MAN", codes.ROSTER_TYPES, "roster_type") == "40Man"
    for wrong in (lambda: codes.pitch_code("XX"), lambda: codes.position_code("goalie"), lambda: codes.choose("x", ("a",), "l")):
        with pytest.raises(InvalidParameter):
            wrong()
    assert column(codes.pitch_code_column, ["slider", "SL", "??"]) == ["SL", "SL", None]


def test_lenient_double_has_no_nan(column):
    assert not any(v is not None and math.isnan(v) for v in column(clean.lenient_double, ["nan", "NaN", " NAN "]))
