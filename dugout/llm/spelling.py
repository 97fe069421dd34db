"""Spelling variants: words at one letter's distance by PartEnum signatures, chained to the spelling they come from.

A word is seen as the multiset of its letters, that is as a binary vector with a
one for each (letter, occurrence). One letter replaced gives a Hamming distance of
two, one letter more or less a distance of one. PartEnum deals the letters out to
partitions: with ``k + 1`` of them, two vectors at a distance of at most ``k``
agree on one at least, so a word has one exact signature for each partition, words
that share a signature are joined, and the pairs are verified.

Letters alone would bring all words of the same letters together. A single edit
also leaves all but one of ``SEGMENTS`` stretches of a word as they are; so a
signature holds, for each stretch, the other stretches letter by letter and the
partition's letters of that stretch. It loses no pair and keeps buckets small.

A pair may share several signatures. It comes out of the first one only, which is
told from the two words, so that pairs are never made distinct by another shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import stored, whole_text

#: Fixed values of the contract: letters, the least length and count of a word, how much more frequent a form is.
LETTER = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
MORE_FREQUENT = 10
#: One occurrence in so many, chosen by its checksum, loses a letter.
EVERY = 31

SEGMENTS = 3
#: Partitions of the letters for words of equal length (distance two) and for one letter more (distance one).
EQUAL_PARTS = 3
LONGER_PARTS = 2


def _lower(run: Column) -> Column:
    """Only A-Z in lower case."""
    upper = "".join(map(chr, range(65, 91)))
    return F.when(run.rlike("[À-Þ]"), F.translate(run, upper, upper.lower())).otherwise(F.lower(run))


def words(df: DataFrame, key: str = "doc_id", text: str = "text", every: int = EVERY) -> DataFrame:
    """Different words of all texts with their counts: ``word``, ``n``.

    Words are the maximal runs of letters. Let h be the CRC-32 of ``<key>:<run>``; where
    ``every`` divides h, the run loses its letter at h modulo its length. Kept are words of
    ``LEAST_LETTERS`` letters that occur ``LEAST_COUNT`` times. A null text has no words, a null
    key counts as an empty one, and repeated rows count each time.
    """
    # A shorter run cannot become a word, and a run that is long enough is matched from its start.
    runs = F.explode(F.regexp_extract_all(whole_text(text), F.lit(f"[{LETTER}]{{{LEAST_LETTERS},}}"), F.lit(0)))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    found = df.select(name.alias("key"), runs.alias("run")).select("key", _lower(F.col("run")).alias("run"))
    hashed = found.withColumn("h", F.crc32(F.concat_ws(":", "key", "run").cast("binary")))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


# --- signatures ------------------------------------------------------------------------------


def part_of(code: np.ndarray | int, parts: int) -> np.ndarray | int:
    """The partition that a letter belongs to."""
    return code % parts


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits well stirred."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _signatures(codes: np.ndarray, shorter: int, parts: int) -> Iterator[np.ndarray]:
    """For words of one length, a row of code points each: the signatures by stretch and partition.

    ``shorter`` is the length of the shorter word of a pair: the words' own, or one less. The last
    four bits hold the stretch and the partition.
    """
    length = codes.shape[1]
    letters = _mixed(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    part = part_of(codes, parts)
    for i in range(SEGMENTS):
        start, stop = shorter * i // SEGMENTS, shorter * (i + 1) // SEGMENTS + length - shorter
        rest = np.full(len(codes), shorter * 31 + i, np.uint64)
        for j in [*range(start), *range(stop, length)]:
            rest = rest * np.uint64(0x9E3779B97F4A7C15) + letters[:, j]
        for q in range(parts):
            own = np.where(part[:, start:stop] == q, letters[:, start:stop], np.uint64(0)).sum(1, dtype=np.uint64)
            bits = _mixed(_mixed(rest) + own)
            yield (bits & ~np.uint64(15) | np.uint64(i << 2 | q)).view(np.int64)


def _signed(df: DataFrame, longer: bool, parts: int) -> DataFrame:
    """Every word once per signature: ``sig``, ``word``, ``n``; ``longer`` words look for shorter ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(w) for w in batch.column(0).to_pylist()], np.int64)
            for length in np.unique(sizes):
                rows = pa.array(np.flatnonzero(sizes == length))
                text, n = batch.column(0).take(rows), batch.column(1).take(rows)
                codes = np.frombuffer("".join(text.to_pylist()).encode("utf-32-le"), np.uint32).reshape(len(rows), length)
                for sig in _signatures(codes, int(length) - longer, parts):
                    yield pa.RecordBatch.from_arrays([pa.array(sig), text, n], ["sig", "word", "n"])

    return df.select("word", "n").mapInArrow(run, "sig bigint, word string, n bigint")


def _letters_of(word: Column, q: int) -> Column:
    """The word's letters of a partition, in their order."""
    others = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)] if part_of(c, EQUAL_PARTS) != q]
    return F.translate(word, "".join(others), "")


def near_pairs(found: DataFrame) -> DataFrame:
    """Pairs of words that differ by exactly one letter inserted, deleted or replaced, each once.

    ``found`` has different words in lower case and their counts. Returns ``a``, ``n_a``, ``b``, ``n_b``:
    of equal length with a before b, or b one letter longer.
    """
    close = F.levenshtein("a", "b", 1) == 1
    sig = F.col("sig")

    def sides(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.select("sig", F.col("word").alias("a"), F.col("n").alias("n_a")).join(
            right.select("sig", F.col("word").alias("b"), F.col("n").alias("n_b")), "sig"
        )

    # The replaced letters touch one or two partitions; the first untouched one gives the pair.
    equal = _signed(found, False, EQUAL_PARTS)
    touched = [_letters_of(F.col("a"), q) != _letters_of(F.col("b"), q) for q in range(EQUAL_PARTS - 1)]
    q = sig.bitwiseAND(3)
    first = F.when(q == 0, True).when(q == 1, touched[0]).otherwise(touched[0] & touched[1])
    replaced = sides(equal, equal).filter((F.col("a") < F.col("b")) & close & first)

    # The letter more may stand in a run of its like over two stretches; the first of them gives the pair.
    size = F.length("a")
    stretch = F.shiftright(sig, 2).bitwiseAND(3).cast("int")
    tail = size - F.floor(size * stretch / SEGMENTS).cast("int")
    first = (stretch == 0) | (F.right("a", tail) != F.right("b", tail))
    inserted = sides(_signed(found, False, LONGER_PARTS), _signed(found, True, LONGER_PARTS)).filter(close & first)
    return replaced.unionByName(inserted).drop("sig")


# --- forms and roots -------------------------------------------------------------------------


def _forms(found: DataFrame, ratio: int) -> DataFrame:
    """Every word with the number of its near words and the most frequent of them, if that is much more frequent."""

    def towards(word: str, n: str, near: str, n_near: str) -> Column:
        form = F.when(F.col(n_near) >= ratio * F.col(n), F.struct((-F.col(n_near)).alias("less"), F.col(near).alias("form")))
        return F.struct(F.col(word).alias("word"), F.lit(None).cast("bigint").alias("n"), F.lit(1).alias("near"), form.alias("best"))

    both = F.explode(F.array(towards("a", "n_a", "b", "n_b"), towards("b", "n_b", "a", "n_a"))).alias("row")
    near = near_pairs(found).select(both).select("row.*")
    alone = found.select("word", "n", F.lit(0).alias("near"), F.lit(None).cast("struct<less:bigint,form:string>").alias("best"))
    grouped = alone.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return grouped.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def _roots(links: DataFrame) -> DataFrame:
    """Where each word's chain of forms ends: the links are doubled until none moves.

    A form is ``MORE_FREQUENT`` times as frequent as its word, so chains are short and have no circles.
    """
    roots = stored(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not roots.filter("moved").isEmpty():
        next_ones = roots.select(F.col("word").alias("root"), F.col("root").alias("after"))
        moved = F.col("after").isNotNull()
        roots = stored(roots.join(next_ones, "root", "left").select("word", F.coalesce("after", "root").alias("root"), moved.alias("moved")), "roots")
    return roots.drop("moved")


def variants(df: DataFrame, key: str = "doc_id", text: str = "text", every: int = EVERY, ratio: int = MORE_FREQUENT) -> DataFrame:
    """Words of all texts with their spelling's origin: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are those of ``words``. Two are near if one letter inserted, deleted or replaced makes one
    the other. A word's form is its most frequent near word (of equally frequent ones the first by code
    points) if that is ``ratio`` times as frequent, else null; its root is where the forms lead, the
    word itself without a form. Texts without words and empty tables give no rows; further columns are
    not looked at.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    found = stored(_forms(stored(words(df, key, text, every), "words"), ratio), "forms")
    linked = found.filter("form is not null")
    rooted = linked.join(_roots(linked), "word")
    alone = found.filter("form is null").withColumn("root", F.col("word"))
    return rooted.unionByName(alone).select("word", "form", "root", "n", "n_near", "form_n")
