"""Column functions for cleaning landed text.

Every function maps Columns to a Column built from Spark's own functions, so
they stay inside generated code. The one exception, name similarity, lives in
``dugout.operators.lookup``.
"""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NULL_TOKENS = ("---%", "---", "", "None", "nan", "none", "null")
CELL_NULL_WORDS = ("nan", "none", "null")
CELL_NULL_DASHES = ("", "---", "---%")
NUMERIC_NULL_WORDS = ("", "nan", "na", "n/a", "null", "none")
GAMES_BACK_NULLS = ("--", "-", "Tied")
GENERIC_EVENT_WORDS = ("hit", "out", "play")
TAG_PATTERN = "<[^>]+>"
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# How a text begins that can be read as a number at all, NaN aside, and a whole number with or without a fraction.
NUMBER_START = rf"^[\x00-\x20{WHITESPACE}]*[+-]?[.0-9iI]"
NUMBER_OR_NAN_START = r"^[\x00-\x20\x7f-\xa0]*[+-]?[.0-9iInN]"
WHOLE_NUMBER = rf"^[{WHITESPACE}]*([+-]?[0-9]{{1,19}})(?:\.[0-9]*)?[{WHITESPACE}]*$"
MISSING_ID = -1
SPRAY_ORIGIN_X = 125.42
SPRAY_ORIGIN_Y = 198.27
FOUR_K_LABEL = 4
FOUR_K_BITRATE = 4000
KILOBITS_PER_MEGABIT = 1000


def trim_text(col: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def null_tokens(col: Column) -> Column:
    """Exact null tokens become null, everything else stays as it is."""
    return F.when(~col.isin(*NULL_TOKENS), col)


def cell_text(col: Column) -> Column:
    """Trimmed table cell; null words in any case and dashes become null."""
    text = trim_text(col)
    is_null = text.isin(*CELL_NULL_DASHES) | F.lower(text).isin(*CELL_NULL_WORDS)
    return F.when(~is_null, text)


def percent_fraction(col: Column) -> Column:
    """``12.5%`` to 0.125; other text is read as a number or becomes null."""
    as_percent = F.regexp_replace(col, "%", "").try_cast("double") / F.lit(100.0)
    return F.when(F.endswith(col, F.lit("%")), as_percent).otherwise(col.try_cast("double"))


def thousands_int(col: Column) -> Column:
    """``1,234`` to 1234; text that is no whole number becomes null."""
    return F.regexp_replace(col, ",", "").try_cast("bigint")


def try_double(col: Column) -> Column:
    """Number text to double, other text to null. A cast that fails makes an exception, so plain words are kept from it."""
    return F.when(F.rlike(col, F.lit(NUMBER_OR_NAN_START)), col.try_cast("double"))


def captured_int(col: Column, pattern: str) -> Column:
    """The first group of a pattern as a whole number, null where it is not found."""
    return F.when(F.rlike(col, F.lit(pattern)), F.regexp_extract(col, pattern, 1).try_cast("bigint"))


def lenient_double(col: Column) -> Column:
    """Number text to double; blanks, null words, NaN and other text to null."""
    return F.when(F.rlike(col, F.lit(NUMBER_START)), trim_text(col).try_cast("double"))


def lenient_int(col: Column) -> Column:
    """Like :func:`lenient_double`, then cut towards zero; plain digits keep all their places."""
    return F.coalesce(captured_int(col, WHOLE_NUMBER), lenient_double(col).try_cast("bigint"))


def strict_double(col: Column, null_values: tuple[str, ...] = ()) -> Column:
    """Number text to double; listed values to null; other text fails the job."""
    if not null_values:
        return col.cast("double")
    return F.when(~col.isin(*null_values), col).cast("double")


def strip_tags(col: Column) -> Column:
    return trim_text(F.regexp_replace(col, TAG_PATTERN, ""))


@functools.cache
def _accent_tables() -> tuple[str, str]:
    """Source and target alphabets for ``translate``, derived from Unicode.

    A composed letter maps to what is left of its canonical decomposition when
    the marks U+0300 to U+036F are gone; bare marks have no target and vanish.
    """
    marks = "".join(chr(cp) for cp in range(0x0300, 0x0370))
    source, target = [], []
    for cp in range(0x80, 0x10000):
        if 0xD800 <= cp < 0xE000 or chr(cp) in marks:
            continue
        base = re.sub("[̀-ͯ]", "", unicodedata.normalize("NFD", chr(cp)))
        if len(base) == 1 and base != chr(cp):
            source.append(chr(cp))
            target.append(base)
    return "".join(source) + marks, "".join(target)


def strip_accents(col: Column) -> Column:
    """Letters without their accents, computed inside the JVM."""
    source, target = _accent_tables()
    return F.translate(col, source, target)


def strip_accents_text(value: str) -> str:
    """The same rule for a value known while the plan is built."""
    source, target = _accent_tables()
    return value.translate(str.maketrans(source, target.ljust(len(source), "\0"))).replace("\0", "")


def id_after(col: Column, marker: str) -> Column:
    """Text after the last ``marker`` of a link, null when there is none."""
    return F.when(F.contains(col, F.lit(marker)), F.substring_index(col, marker, -1))


def url_bitrate(url: Column) -> Column:
    """Kilobits named in a URL (``2500K``), 0 when there are none."""
    return F.coalesce(captured_int(url, r"(\d+)[kK]"), F.lit(0))


def label_bitrate(name: Column, url: Column) -> Column:
    """Bitrate from a label or else the URL; ``4K`` means 4000, ``8M`` 8000."""
    kilo = F.coalesce(
        captured_int(name, r"(?i)(\d+)K"),
        captured_int(url, r"(?i)(\d+)K"),
    )
    mega = captured_int(name, r"(?i)(\d+)M")
    return F.coalesce(
        F.when(kilo == FOUR_K_LABEL, F.lit(FOUR_K_BITRATE)).otherwise(kilo),
        mega * KILOBITS_PER_MEGABIT,
        F.lit(0),
    ).cast("bigint")


def event_kind(col: Column) -> Column:
    """The last telling entry of ``[a, b, c]``; generic words only as a last resort."""
    bare = F.regexp_replace(col, r"^[\[\]]+|[\[\]]+$", "")
    parts = F.filter(F.transform(F.split(bare, ","), trim_text), lambda p: p != "")
    telling = F.filter(parts, lambda p: ~F.lower(p).isin(*GENERIC_EVENT_WORDS))
    last = lambda a: F.try_element_at(a, F.lit(-1))
    return F.coalesce(last(telling), last(parts), col)


def iso_date(col: Column) -> Column:
    """Date of an ISO date or timestamp text, null when it is none."""
    day = F.substring_index(col, "T", 1)
    return F.when(F.rlike(day, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}$")), F.try_to_date(day, "yyyy-M-d"))


def name_key(col: Column) -> Column:
    """Lower-cased name without spaces and hyphens."""
    return F.regexp_replace(F.lower(col), "[ -]", "")


def id_or_sentinel(col: Column, sentinel: int = MISSING_ID) -> Column:
    return F.coalesce(col.cast("bigint"), F.lit(sentinel).cast("bigint"))


def full_name(first: Column, last: Column) -> Column:
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def length_near(col: Column, length: int, tolerance: int) -> Column:
    return F.char_length(col).between(max(1, length - tolerance), length + tolerance)


def joined_text(*cols: Column, separator: str = ", ") -> Column:
    """Texts joined by ``separator``, whose characters are cut from both ends."""
    parts = [F.coalesce(c, F.lit("")) for c in cols]
    return F.btrim(F.concat_ws(separator, *parts), F.lit(separator))


def spray_angle(hc_x: Column, hc_y: Column) -> Column:
    return F.degrees(F.atan2(hc_x - SPRAY_ORIGIN_X, F.lit(SPRAY_ORIGIN_Y) - hc_y))


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Rounded ratio, null where the denominator is 0."""
    return F.round(numerator / F.nullif(denominator, F.lit(0)), digits)


def batting_order(col: Column) -> Column:
    return trim_text(col).try_cast("bigint")


def first_present(*cols: Column) -> Column:
    return F.coalesce(*cols)


def utf8_or_latin1(content: Column) -> Column:
    """Text of a byte column: UTF-8 where valid, Latin-1 otherwise."""
    text = F.try_validate_utf8(content.cast("string"))
    return F.coalesce(text, F.decode(content, "ISO-8859-1"))
