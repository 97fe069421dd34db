"""Queries on the driver's tables, one per operator, with their checking SQL."""

from dugout.plans.catalog import boards, feeds, joins, lookups, pages, pitches, rows, scalars, sources, streams, unions
from dugout.plans.catalog.base import ORACLE, QUERIES

__all__ = [
    "ORACLE",
    "QUERIES",
    "boards",
    "feeds",
    "joins",
    "lookups",
    "pages",
    "pitches",
    "rows",
    "scalars",
    "sources",
    "streams",
    "unions",
]
