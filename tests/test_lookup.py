from __future__ import annotations

import random
from difflib import get_close_matches

from dugout.operators import lookup

PEOPLE = [
    ("Trout", "Mike", 545361),
    ("Judge", "Aaron", 592450),
    ("Valenzuéla", "Fernando", 123),
    ("Trout", "Steve", 9),
]


def _table(spark, people=PEOPLE):
    df = spark.createDataFrame(people, "name_last string, name_first string, key_mlbam bigint")
    return lookup.lookup_table(df)


def _ids(df):
    return sorted(r.key_mlbam for r in df.collect())


def test_exact_and_accent_free(spark):
    table = _table(spark)
    assert _ids(lookup.find_player(table, "TROUT", "mike")) == [545361]
    assert _ids(lookup.find_player(table, "trout")) == [9, 545361]
    found = lookup.find_player(table, "valenzuela", ignore_accents=True)
    assert [r.name_last for r in found.collect()] == ["valenzuéla"] and "name_last_plain" not in found.columns
    assert _ids(lookup.find_player(table, "valenzuela")) == []


def test_suggestions(spark):
    table = _table(spark)
    assert _ids(lookup.suggest_players(table, "trut", "mike")) == [9, 545361]
    assert 123 in _ids(lookup.suggest_players(table, "valenzula", ignore_accents=True))
    assert _ids(lookup.suggest_players(table, "xjqwz", "qwe")) == []


def _by_hand(people, last, first):
    """The same rule with the standard library, one entry at a time."""
    names = [(f"{f.lower()} {n.lower()}", n, i) for n, f, i in people]
    close = get_close_matches(f"{first} {last}", [n for n, _, _ in names], n=5, cutoff=0.5)
    return sorted(i for n, _, i in names if n in close)


def test_suggestions_equal_the_standard_library(spark):
    rng = random.Random(7)
    for size in (60, 1500):
        people = [
            ("".join(rng.choices("aeinrst", k=rng.randint(2, 9))), rng.choice(["Al", "Bo", "Cy", "Ed"]), i) for i in range(size)
        ]
        table = _table(spark, people).cache()
        for last, first in (("raines", "al"), ("stain", "bo"), ("e", "cy")):
            assert _ids(lookup.suggest_players(table, last, first)) == _by_hand(people, last, first)


def test_more_names_hide_no_candidate(spark):
    """The same name has the same candidates below and above a thousand rows."""
    far = [("q" * 12, "zz", 10_000 + i) for i in range(1500)]
    few, many = _table(spark), _table(spark, PEOPLE + far)
    for last, first in (("trut", "mike"), ("judgemental", "aaron")):
        assert _ids(lookup.suggest_players(few, last, first)) == _ids(lookup.suggest_players(many, last, first)) != []
    assert _ids(lookup.suggest_players(many, "judgemental", "aaron", tolerance=1)) == []
    assert len(_ids(lookup.suggest_players(few, "trut", "mike", limit=1))) == 1


def test_batch_suggestions_equal_single_ones(spark):
    rng = random.Random(3)
    people = [("".join(rng.choices("aeinrst", k=rng.randint(2, 9))), rng.choice(["Al", "Bo"]), i) for i in range(1200)]
    table = _table(spark, people).cache()
    wanted = [("raines", "al"), ("stain", "bo")]
    batch = lookup.suggest_many(table, wanted).collect()
    for last, first in wanted:
        single = lookup.suggest_players(table, last, first).collect()
        names = {f"{r.name_first} {r.name_last}" for r in single}
        assert {r.candidate for r in batch if r["query"] == f"{last}, {first}"} == names


def test_register(spark):
    people = spark.createDataFrame(
        [("A", "B", 5, "r1", None), ("C", "D", None, None, 7), ("E", "F", 6, None, None)],
        "name_last string, name_first string, key_mlbam bigint, key_retro string, key_fangraphs int",
    )
    rows = {r.name_last: r for r in lookup.normalize_register(people).collect()}
    assert set(rows) == {"A", "C"}
    assert rows["A"].key_fangraphs == -1 and rows["C"].key_mlbam == -1 and rows["A"].key_bbref is None
