"""Source divergence audit by in-mapper stripes.

Each partition folds whole documents into hash stripes: for a term of a language,
how many documents and occurrences every source has. When the hash is full its
stripes are written out ("spilled") and the fold goes on; stripes of the same term
are merged by key. A merged stripe knows all counts of its term, so it directly
emits the term's share of every divergence; only these sums and the best terms of
each group are shuffled again.

All arithmetic is exact: probabilities are whole numbers of billionths.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import row_chunks, stored, whole_text

#: Entries (term and source) that a partition holds before it spills.
HELD_ENTRIES = 250_000
#: Fixed values of the contract: documents that a term needs, the scale of probabilities, terms listed per group.
LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
BEST = 10
#: Counts (terms by sources) that are worked on at once.
CELLS = 1 << 18

_LETTERS = bytes(range(65, 91))
#: Bytes of terms stay, A-Z in lower case; all others become spaces.
_FOLD = bytes(b + 32 if b in _LETTERS else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Runs of Latin letters and of all characters beyond ASCII, A-Z in lower case, in UTF-8."""
    return text.encode().translate(_FOLD).split()


_STRIPE = pa.schema(
    [
        ("lang", pa.string()),
        ("term", pa.string()),
        ("entries", pa.list_(pa.struct([("source", pa.string()), ("docs", pa.int64()), ("n", pa.int64())]))),
    ]
)
_PAIRS = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])
_TERMS = pa.schema([("lang", pa.string()), ("number", pa.int32()), ("item", pa.string()), ("value", pa.int64())])


class Stripes:
    """Documents folded into stripes: by language and term, each source's documents and occurrences."""

    def __init__(self) -> None:
        self.by_lang: dict[str, dict[bytes, dict[str, list[int]]]] = {}
        self.entries = 0

    def fold(self, lang: str, source: str, text: str) -> None:
        stripes = self.by_lang.setdefault(lang, {})
        for term, n in Counter(terms_of(text)).items():
            stripe = stripes.get(term)
            if stripe is None:
                stripes[term] = {source: [1, n]}
                self.entries += 1
                continue
            entry = stripe.get(source)
            if entry is None:
                stripe[source] = [1, n]
                self.entries += 1
            else:
                entry[0] += 1
                entry[1] += n

    def spill(self, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
        """All stripes, in batches; nothing is held afterwards."""
        for lang, stripes in self.by_lang.items():
            items = list(stripes.items())
            for start in range(0, len(items), rows):
                part = items[start : start + rows]
                sources = [s for _, stripe in part for s in stripe]
                counts = [e for _, stripe in part for e in stripe.values()]
                ends = [0]
                for _, stripe in part:
                    ends.append(ends[-1] + len(stripe))
                entries = pa.StructArray.from_arrays(
                    [pa.array(sources, pa.string()), pa.array([c[0] for c in counts], pa.int64()), pa.array([c[1] for c in counts], pa.int64())],
                    ["source", "docs", "n"],
                )
                columns = [
                    pa.array([lang] * len(part), pa.string()),
                    pa.array([term for term, _ in part], pa.binary()).cast(pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_STRIPE)
        self.by_lang, self.entries = {}, 0


def _named(df: DataFrame) -> DataFrame:
    """Language, source and text with null as the empty string."""
    empty = F.lit("")
    return df.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source")], whole_text().alias("text"))


def stripes(df: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Merged stripes of the terms that ``least`` documents of their language hold: ``lang``, ``term``, ``counts``.

    ``counts`` maps each source that has the term to its number of occurrences there. Spilled stripes
    are merged by term; of a frequent term each partition sends as many stripes as it spills.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for langs, sources, texts in row_chunks(batches):
            for row in zip(langs, sources, texts, strict=True):
                held.fold(*row)
                if held.entries >= HELD_ENTRIES:
                    yield from held.spill()
        yield from held.spill()

    kind = "lang string, term string, entries array<struct<source:string,docs:bigint,n:bigint>>"
    spilled = _named(df).mapInArrow(run, kind)
    # One exchange by term; both groupings below work on it.
    entries = spilled.repartition("lang", "term").select("lang", "term", F.inline("entries"))
    merged = entries.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    whole = merged.groupBy("lang", "term").agg(F.sum("docs").alias("df"), F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("counts"))
    return whole.filter(F.col("df") >= least).select("lang", "term", "counts")


# --- divergences -----------------------------------------------------------------------------


def share(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """Smoothed probabilities in units of one by ``SCALE``: 1 + floor(SCALE * (count + 2) / (total + 2 * terms)).

    Divided three decimal places at a time, so that 64 bits hold all steps up to totals of 9e15.
    """
    under = total + 2 * terms
    whole, rest = np.divmod(counts + 2, under)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, under)
        whole = whole * 1000 + digits
    return whole + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); probabilities are at most SCALE + 1, so 64 bits hold all steps."""
    return (p - q) * (p - q) // (p + q)


def _profiles(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """A row per language: its sources in order, their totals over kept terms, its number of kept terms."""
    totals = kept.select("lang", F.explode("counts").alias("source", "n")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    each = groups.join(totals, ["lang", "source"], "left").select("lang", F.struct("source", F.coalesce("total", F.lit(0)).alias("total")).alias("group"))
    by_lang = each.groupBy("lang").agg(F.array_sort(F.collect_list("group")).alias("groups"))
    joined = by_lang.join(sizes, "lang", "left").withColumn("terms", F.coalesce("terms", F.lit(0)))
    return joined.select("lang", F.col("groups.source").alias("sources"), F.col("groups.total").alias("totals"), "terms")


def _emitted(stripes: DataFrame, schema: pa.Schema, kind: str, emit: Callable) -> DataFrame:
    """What whole stripes give: ``emit`` has the language, terms, counts and probabilities of some, and the language's probabilities."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                rows = batch.filter(pc.equal(langs.indices, code))
                totals = rows.column(3)[0].values.to_numpy().astype(np.int64)
                size = int(rows.column(4)[0].as_py())
                step = max(1, CELLS // len(totals))
                for start in range(0, rows.num_rows, step):
                    part = rows.slice(start, step)
                    counts = part.column(2).flatten().to_numpy().reshape(part.num_rows, -1)
                    p = share(counts, totals, size)
                    q = share(counts.sum(1), totals.sum(), size)
                    for columns in emit(part.column(1), counts, p, q):
                        n = len(columns[0])
                        arrays = [pa.array([lang] * n, pa.string()), *columns]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(arrays, schema, strict=True)], schema=schema)

    return stripes.mapInArrow(run, kind)


def _pairs(terms: pa.Array, counts: np.ndarray, p: np.ndarray, q: np.ndarray) -> Iterator[tuple]:
    """Every two sources by number, with the divergence summed over these terms."""
    for a in range(p.shape[1] - 1):
        sums = apart(p[:, a : a + 1], p[:, a + 1 :]).sum(0)
        yield np.full(len(sums), a, np.int32), np.arange(a + 1, p.shape[1], dtype=np.int32), sums


def _overused(terms: pa.Array, counts: np.ndarray, p: np.ndarray, q: np.ndarray) -> Iterator[tuple]:
    """Sources by number and the terms that they use more than their language does."""
    rows, sources = np.nonzero((counts > 0) & (p > q[:, None]))
    yield sources.astype(np.int32), terms.take(pa.array(rows)), apart(p[rows, sources], q[rows])


def divergences(df: DataFrame, least: int = LEAST_DOCUMENTS, best: int = BEST) -> DataFrame:
    """How far sources of a language are apart: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair`` has each other source of the language with the divergence summed over all kept terms,
    all ranks. Part ``term`` has the kept terms that the source uses more than its language does,
    by their share of the divergence from the language, the first ``best`` of them. Ranks start at 1 in
    each group and part, by falling value, then by item. A language without kept terms has pairs of
    value 0; null language, source and text count as empty; repeated rows count each time. A language's
    sources stand in one row, as its pairs stand in the result.
    """
    kept = stored(stripes(df, least), "stripes")
    groups = stored(_named(df).select("lang", "source").distinct(), "groups")
    profiles = stored(_profiles(kept, groups), "profiles")
    dense = F.transform("sources", lambda s: F.coalesce(F.try_element_at("counts", s), F.lit(0).cast("bigint")))
    whole = kept.join(profiles, "lang").select("lang", "term", dense.alias("counts"), "totals", "terms")
    # All sums and the terms of all sources by numbers; the names come back at the end.
    names = profiles.select("lang", "sources")

    def name(number: str) -> Column:
        return F.element_at("sources", F.col(number) + 1)

    sums = _emitted(whole, _PAIRS, "lang string, a int, b int, value bigint", _pairs).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(*[F.struct(F.col(x).alias("one"), F.col(y).alias("other")) for x, y in ("ab", "ba")]))
    known = sums.select("lang", sides.alias("row"), "value").select("lang", "row.*", "value").join(names, "lang")
    known = known.select("lang", name("one").alias("source"), name("other").alias("item"), "value")
    wanted = names.select("lang", F.explode("sources").alias("source"), "sources")
    wanted = wanted.select("lang", "source", F.explode("sources").alias("item")).filter("source != item")
    found = wanted.join(known, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("bigint")))

    over = _emitted(whole, _TERMS, "lang string, number int, item string, value bigint", _overused)

    def ranked(rows: DataFrame, group: str) -> DataFrame:
        order = Window.partitionBy("lang", group).orderBy(F.desc("value"), "item")
        return rows.withColumn("rank", F.row_number().over(order))

    pairs = ranked(found, "source").select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    terms = ranked(over, "number").filter(F.col("rank") <= best).join(names, "lang")
    return pairs.unionByName(terms.select("lang", name("number").alias("source"), F.lit("term").alias("part"), "item", "value", "rank"))
