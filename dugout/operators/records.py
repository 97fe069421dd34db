"""CSV that lies inside text columns: records and cells by the rule of quotes.

A cell that opens with a quote ends at the next single quote; commas and line breaks
before it belong to the cell, two quotes stand for one. One pattern takes a cell with
what ends it, without going back, so the work grows with the text and not with its square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.operators.names import once, ref

#: A cell, quoted (an unclosed quote runs to the end) or plain, and the end of a record.
CELL = r'(?:[ \t]*+"[^"]*+(?:""[^"]*+)*+(?:"|\z)[^,\r\n]*+|[^,\r\n]*+)'
BREAK = r"(?:\r?\n|\r)"
RECORD = f"(?:{CELL},)*+{CELL}"


def raw_cells(text: Column) -> Column:
    """All cells of a text one after the other, each with the comma or line break that ends it."""
    found = F.regexp_extract_all(F.concat(text, F.lit("\n")), F.lit(rf"{CELL}(?:,|{BREAK}|\z)"), F.lit(0))
    return F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0)))  # at the very end the pattern takes nothing once more


def bare(cell: Column) -> Column:
    """A raw cell's text: without its end, outer quotes and the spaces around them."""
    text = F.trim(F.regexp_replace(cell, r"(?:,|\r?\n|\r)\z", ""))
    inner = F.replace(F.regexp_replace(text, r'\A"|"\z', ""), F.lit('""'), F.lit('"'))
    return F.when(F.startswith(text, F.lit('"')), inner).otherwise(text)


def first_cells(text: Column, skip: int = 0) -> Column:
    """The cells of one record of a text, the first or after so many others; white space before it is skipped."""
    record = F.regexp_extract(text, rf"\A\s*+(?:{RECORD}{BREAK}){{{skip}}}({RECORD})", 1)
    return F.transform(raw_cells(record), bare)


def with_records(df: DataFrame, text: str, name: str = "_records") -> DataFrame:
    """Add the records of a text column, each an array of raw cells; a blank line is a record of one blank cell."""
    cells = once(df, _cells=raw_cells(ref(text)))
    last = F.transform("_cells", lambda c, i: F.when(c.rlike(r"[\r\n]\z") | (i == F.size("_cells") - 1), i))
    ended = once(cells, _ends=F.filter(last, lambda i: i.isNotNull()))
    start = lambda k: F.when(k > 0, F.get("_ends", k - 1) + 1).otherwise(0)
    records = F.transform("_ends", lambda e, k: F.slice("_cells", start(k) + 1, e - start(k) + 1))
    return once(ended, **{name: records}).drop("_cells", "_ends")
