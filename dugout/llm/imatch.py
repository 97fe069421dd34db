"""I-Match fingerprints with randomised lexicons.

Document frequencies are counted over the different texts of the whole table, so
that a group of copies counts as one. The lexicon keeps terms
within a band of inverse document frequency: log(N / df) between ``IDF_LOW`` and
``IDF_HIGH``. Both ends are relative to N, so the lexicon holds at most (terms per
document) * exp(IDF_HIGH) terms, however many documents there are.

From the lexicon several subsets are drawn by hash: one of all terms, the others
with falling shares of the terms. For each subset the text's distinct terms in it
are sorted and hashed. Subsets with many terms change with every edit, those with
few survive large ones; the likeness of two fingerprints is the share of equal
hashes among the subsets in which either text has a term. A text that has no term
in the lexicon, but is not empty, is hashed by all its distinct terms instead.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dugout.llm.common import Output, per_row, row_chunks, stored, whole_text

IDF_LOW = 1.6
IDF_HIGH = 9.2
#: Shares of the lexicon as powers of one half: that many subsets of each.
SHARES = ((0, 1), (2, 3), (4, 6), (5, 8), (6, 10), (7, 12), (8, 12), (9, 12))
SUBSETS = sum(n for _, n in SHARES)
#: Distinct terms counted in a task before the counts are passed on.
PART_TERMS = 400_000
#: Hashes of texts with copies up to which their table is broadcast: 1,000,000 rows of about 16 bytes.
BROADCAST_ROWS = 1_000_000

_MARKS = ".,;:!?\"'()[]{}<>|*#$%&+-=/\\_~^`«»“”‘’…–—"
_HEX = 8  # hexadecimal digits of a subset's hash
_NONE = "-" * _HEX


def terms(text: str) -> set[str]:
    """Distinct words in lower case, without punctuation around them."""
    found = {word.strip(_MARKS) for word in set(text.lower().split())}
    found.discard("")
    return found


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (term hash, documents with it), added up as far as memory is set aside for it."""
    counts: Counter[str] = Counter()

    def batch() -> pa.RecordBatch:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts)).view(np.int64)
        out = pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(counts.values(), pa.int64())], ["term", "df"])
        counts.clear()
        return out

    for (texts,) in row_chunks(batches):
        for text in texts:
            counts.update(terms(text))
            if len(counts) >= PART_TERMS:
                yield batch()
    if counts:
        yield batch()


def different_texts(df: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """(text) once each, and how many. Only texts whose hash occurs again are shuffled."""
    rows = df.select(whole_text(text).alias("text")).withColumn("h", F.xxhash64("text"))
    hashes = stored(rows.groupBy("h").agg((F.count("*") > 1).alias("again")), "text-hashes")
    again = hashes.filter("again").select("h")
    if again.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        again = F.broadcast(again)
    copies = rows.join(again, "h", "leftsemi").select("text").distinct()
    return rows.join(again, "h", "leftanti").select("text").unionByName(copies), hashes.count()


def document_frequencies(texts: DataFrame, text: str = "text") -> DataFrame:
    """(term, df): hash of every term and the number of rows that hold it."""
    counted = texts.select(whole_text(text).alias("text")).mapInArrow(_count, "term bigint, df bigint")
    return counted.groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(df: DataFrame, text: str = "text", low: float = IDF_LOW, high: float = IDF_HIGH) -> np.ndarray:
    """Hashes of the terms within the band, ascending; their number is bounded by the band.

    Terms of a single text are left out: they tell nothing about a second one.
    """
    texts, documents = different_texts(df, text)
    frequencies = document_frequencies(texts)
    idf = F.log(F.lit(float(max(1, documents))) / F.col("df"))
    kept = frequencies.filter(idf.between(low, high) & (F.col("df") > 1)).select("term").toPandas()["term"]
    return np.sort(kept.to_numpy(np.int64))


def _subset_bits(terms: np.ndarray) -> np.ndarray:
    """For every term a 64-bit mask of the subsets that hold it; a smaller share is drawn anew, not nested."""
    bits = np.zeros(len(terms), np.uint64)
    number = 0
    for power, count in SHARES:
        for _ in range(count):
            x = terms.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (number + 1) & 0xFFFFFFFFFFFFFFFF)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            chosen = (x >> np.uint64(64 - power)) == 0 if power else np.ones(len(terms), bool)
            bits |= chosen.astype(np.uint64) << np.uint64(number)
            number += 1
    return bits


class Printer:
    """Makes fingerprints with one lexicon; remembers where terms stand in it, up to a bound."""

    MEMORY = 500_000

    def __init__(self, kept: np.ndarray) -> None:
        self.places = {h: i for i, h in enumerate(kept.view(np.uint64).tolist())}
        self.bits = _subset_bits(kept)
        self.hashes = kept
        self.known: dict[str, int] = {}
        self.shifts = np.arange(SUBSETS, dtype=np.uint64)[:, None]

    def place(self, term: str) -> int:
        """Rank of the term in the lexicon, -1 if it is not in it."""
        found = self.known.get(term)
        if found is None:
            if len(self.known) >= self.MEMORY:
                self.known.clear()
            found = self.known[term] = self.places.get(xxhash.xxh3_64_intdigest(term), -1)
        return found

    def fingerprint(self, text: str) -> str:
        """Hashes of the text's terms in every subset, as hexadecimal digits; dashes where it has none.

        Of a text without a term in the lexicon all distinct terms count, or its
        words as they are if they hold nothing but punctuation.
        """
        found = terms(text)
        own = np.array([p for p in map(self.place, found) if p >= 0], np.int64)
        own.sort()
        values, bits = self.hashes[own], self.bits[own]
        if not len(own) and (found := found or set(text.split())):
            values = np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64))
            bits = _subset_bits(values)
        held = (bits >> self.shifts & np.uint64(1)).astype(bool)
        out = []
        for row in held:
            kept = values[row].tobytes()
            out.append(hashlib.blake2b(kept, digest_size=_HEX // 2).hexdigest() if kept else _NONE)
        return "".join(out)


_PRINTERS: dict[str, Printer] = {}


def _printer(name: str, kept: np.ndarray) -> Printer:
    """The worker's printer of a lexicon, made once; that of an earlier one goes."""
    if name not in _PRINTERS:
        _PRINTERS.clear()
        _PRINTERS[name] = Printer(kept)
    return _PRINTERS[name]


def fingerprints(df: DataFrame, kept: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint`` of every row; a null or empty text has dashes only."""
    name = hashlib.sha256(kept.tobytes()).hexdigest()

    def make(k, body):
        return (k, _printer(name, kept).fingerprint(body)), SUBSETS * _HEX

    kind = df.schema[key].dataType
    schema = pa.schema([("key", to_arrow_type(kind)), ("fingerprint", pa.string())])
    source = df.select(F.col(key).alias("key"), whole_text(text).alias("body"))
    found = source.mapInArrow(per_row(make, schema), f"key {kind.simpleString()}, fingerprint string")
    return found.withColumnRenamed("key", key)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subset hashes among the subsets in which either text has a term; equal fingerprints give 1."""
    places = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    pick = lambda c, i: F.substring(c, i * _HEX + 1, F.lit(_HEX))
    either = F.size(F.filter(places, lambda i: (pick(a, i) != _NONE) | (pick(b, i) != _NONE)))
    equal = F.size(F.filter(places, lambda i: (pick(a, i) == pick(b, i)) & (pick(a, i) != _NONE)))
    return F.when(a == b, F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(None)).otherwise(equal / F.greatest(either, F.lit(1)))


def print_likeness(a: str, b: str) -> float:
    """``likeness`` of two fingerprints, where the texts are at hand."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(f.encode(), f"S{_HEX}") for f in (a, b))
    held = x != _NONE.encode()
    return int((held & (x == y)).sum()) / max(1, int((held | (y != _NONE.encode())).sum()))


def in_order(df: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """``range``, ``guest``, ``key``, ``text``: rows by descending key, each range of keys in one sorted run.

    No task sees the whole order. The first rows of a range come once more, as
    guests, at the end of the run before it; those of the first range end the last
    run, so that every row is followed by its successor and the last by the first.
    Equal keys are ordered by text, null keys come last.
    """
    parts = parts or min(4000, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = df.schema[key].dataType
    rows = df.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    cuts = rows.select(F.percentile_approx("key", [i / parts for i in range(1, parts)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    above = F.array(*[F.lit(c).cast(kind) for c in cuts])
    ranged = rows.withColumn(
        "range", F.when(F.col("key").isNull(), F.lit(len(cuts))).otherwise(F.size(F.filter(above, lambda c: c > F.col("key"))))
    )
    # The ranges that hold rows and the largest key of each: as many rows as ranges.
    firsts = sorted((r["range"], r["first"]) for r in ranged.groupBy("range").agg(F.max("key").alias("first")).collect())
    both = ranged.withColumn("guest", F.lit(0))
    if firsts:
        before = F.create_map(*[F.lit(x) for i, (own, _) in enumerate(firsts) for x in (own, firsts[i - 1][0])])
        first = F.create_map(*[x for own, key_ in firsts for x in (F.lit(own), F.lit(key_).cast(kind))])
        guests = ranged.filter(F.col("key").eqNullSafe(first[F.col("range")])).withColumn("range", before[F.col("range")])
        both = both.unionByName(guests.withColumn("guest", F.lit(1)))
    both = both.select("range", "guest", "key", "text")
    return both.repartition("range").sortWithinPartitions("range", "guest", F.col("key").desc_nulls_last(), "text")


def replace_end(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared_in_order(df: DataFrame, kept: np.ndarray, key: str = "doc_id", text: str = "text", near: bool = False) -> DataFrame:
    """Every row's fingerprint, that of its text with the end replaced by the next row's text, and the next row's.

    Returns ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint`` and ``next_fingerprint``; the order is that of
    ``in_order``, and a single row is its own successor. With ``near`` the likeness of
    the first fingerprint to the others, ``near_edited`` and ``near_next``, takes the
    place of ``next_fingerprint``.
    """
    name = hashlib.sha256(kept.tobytes()).hexdigest()
    kind = df.schema[key].dataType
    columns = dict.fromkeys(("edited_sha256", "fingerprint", "edited_fingerprint"), "string")
    columns |= {"near_edited": "double", "near_next": "double"} if near else {"next_fingerprint": "string"}
    types = {"string": pa.string(), "double": pa.float64()}
    schema = pa.schema([("key", to_arrow_type(kind)), ("n_chars", pa.int64()), *((c, types[t]) for c, t in columns.items())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer, out = _printer(name, kept), Output(schema)
        last = None  # range, key, text, fingerprint of the row before
        for chunk in row_chunks(batches):
            for part, guest, k, body in zip(*chunk, strict=True):
                if guest and (last is None or last[0] != part):
                    continue  # of several guests only the first is a successor
                own = printer.fingerprint(body)
                if last is not None and last[0] == part:
                    edited = replace_end(last[2], body)
                    digest = hashlib.sha256(edited.encode()).hexdigest()
                    new = printer.fingerprint(edited)
                    rest = (print_likeness(last[3], new), print_likeness(last[3], own)) if near else (own,)
                    if out.add((last[1], len(last[2]), digest, last[3], new, *rest), 1600):
                        yield out.batch()
                last = None if guest else (part, k, body, own)
        if out.columns[0]:
            yield out.batch()

    fields = f"key {kind.simpleString()}, n_chars bigint, " + ", ".join(f"{c} {t}" for c, t in columns.items())
    return in_order(df, key, text).mapInArrow(run, fields).withColumnRenamed("key", key)
