"""Benchmark decontamination by spaced seeds, in DataFrame functions alone.

Words are hashed. A mask looks at some words of a span of eleven and ignores the
others, so two passages that differ in the ignored words have the same hash. The
benchmark's masked hashes are joined with those at every word of every document; a
hit gives document, item and how far they are shifted. Around the hits the words
themselves are compared at that shift. An overlap counts when enough words of
the item are equal, whichever were replaced and at however many shifts, or when a
stretch of it is nearly equal. Items shorter than the span have masks of their own
length, which look past any one word.

The benchmark side is broadcast when its number of hashes is below a stated
bound, and joined by shuffle beyond it. Items with equal words are one item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import stored, whole_text

SPAN = 11
#: Positions that a mask looks at; two words that are replaced next to each other escape no pair of them.
MASKS = (
    (0, 1, 2, 4, 7, 8, 10),
    (0, 2, 3, 5, 6, 9, 10),
    (0, 1, 4, 5, 6, 8, 10),
)
#: Fewest words an item must have to be looked for.
LEAST_WORDS = 5
#: Share of an item's words that must be equal; or a stretch of so many words with such a share.
COVERAGE = 0.6
STRETCH, STRETCH_SHARE = 13, 0.8
#: Share of the words of an item below SPAN that must be equal: all but one, or but two of ten.
SHORT_COVERAGE = 0.8
#: Benchmark hashes up to which their table is broadcast: 1,000,000 rows of about 40 bytes.
BROADCAST_ROWS = 1_000_000


def word_hashes(text: Column) -> Column:
    """Hashes of the words: runs of letters and digits in lower case."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda word: F.xxhash64(word))


def _masked(hashes: Column, at: Column, shapes: list[tuple[int, ...]]) -> Column:
    """The masked hashes of the spans that begin at a position."""
    return F.array(*[F.xxhash64(F.lit(n), *[F.get(hashes, at + k) for k in shape]) for n, shape in enumerate(shapes)])


def _short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks of an item of n words: each leaves out every third word, so one replaced word escapes one of them."""
    return [tuple(i for i in range(n) if i % 3 != k) for k in range(3)]


def _seeds(rows: DataFrame, keep: list[str], shapes: dict[int, list[tuple[int, ...]]]) -> DataFrame:
    """``keep``, ``at`` and ``seed`` for every span of every row of ``words``; ``shapes`` by length of span."""
    found = None
    for span, masks in sorted(shapes.items()):
        spans = rows.select(*keep, "words", F.posexplode("words").alias("at", "first")).filter(F.col("at") <= F.size("words") - span)
        some = spans.select(*keep, "at", F.explode(_masked(F.col("words"), F.col("at"), masks)).alias("seed"))
        found = some if found is None else found.unionByName(some)
    return found


def overlaps(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents that hold benchmark passages, a row for each document and item.

    Returns ``key``, ``text_id`` (hash of the text), ``item``, ``item_words``,
    ``matched_words`` (of all shifts together), ``coverage`` and ``at`` (word of the
    document where the item would begin at the best shift). Null and empty texts hold nothing. Of items with equal
    words the smallest id is named; items without an id or with fewer than five
    words are not looked for. Documents without a key are reported with a null
    key; repeated rows give one row.
    """
    listed = benchmark.select(F.col(item).alias("item"), word_hashes(whole_text(item_text)).alias("words"))
    listed = listed.filter(F.col("item").isNotNull() & (F.size("words") >= LEAST_WORDS))
    items = stored(listed.groupBy("words").agg(F.min("item").alias("item")).select("item", "words"), "items")
    short = [r[0] for r in items.select(F.size("words").alias("n")).filter(f"n < {SPAN}").distinct().collect()]  # a few lengths
    shapes = {n: _short_masks(n) for n in short} | {SPAN: list(MASKS)}
    seeds = _seeds(items, ["item"], {SPAN: shapes[SPAN]})
    for n in short:
        seeds = seeds.unionByName(_seeds(items.filter(F.size("words") == n), ["item"], {n: shapes[n]}))
    sizes = items.select("item", F.size("words").alias("n"))
    seeds = stored(seeds.select("seed", "item", F.col("at").alias("item_at")).join(sizes, "item").distinct(), "seeds")
    if seeds.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        seeds = F.broadcast(seeds)

    rows = df.select(F.col(key).alias("key"), whole_text(text).alias("text")).withColumn("text_id", F.xxhash64("text"))
    hashed = rows.select("key", "text_id", word_hashes(F.col("text")).alias("words"))
    met = _seeds(hashed, ["key", "text_id"], shapes).join(seeds, "seed")
    met = met.groupBy("key", "text_id", "item", "n", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.min("item_at").alias("lo"), F.max("item_at").alias("hi")
    )
    # Per document: an entry for every item and shift that it meets.
    hits = stored(met.groupBy("key", "text_id").agg(F.collect_list(F.struct("item", "n", "shift", "lo", "hi")).alias("hits")), "hits")

    again = rows.alias("d").join(hits.alias("h"), F.col("d.text_id").eqNullSafe(F.col("h.text_id")) & F.col("d.key").eqNullSafe(F.col("h.key")))
    again = again.select("d.key", "d.text_id", word_hashes(F.col("d.text")).alias("words"), "h.hits")
    pairs = again.select("key", "text_id", "words", F.explode("hits").alias("hit")).select("key", "text_id", "words", "hit.*")
    # Of the document only the words that stand opposite the item's go on.
    seen = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(F.col("words"), F.when(F.col("shift") + i >= 0, F.col("shift") + i)))
    pairs = pairs.select("key", "text_id", "item", "n", "shift", "lo", "hi", seen.alias("seen"))
    both = pairs.join(items.withColumnRenamed("words", "item_words"), "item")
    equal = F.zip_with(F.col("item_words"), F.col("seen"), lambda w, x: F.coalesce(w == x, F.lit(False)))
    judged = both.select("key", "text_id", "item", "n", "shift", "lo", (F.least(F.col("hi") + SPAN, F.col("n")) - F.col("lo")).alias("length"), equal.alias("equal"))
    count = lambda flags: F.size(F.filter(flags, lambda x: x))
    places = F.sequence(F.lit(0), F.col("n") - 1)
    own = F.filter(places, lambda i: (i >= F.col("lo")) & (i < F.col("lo") + F.col("length")) & F.get("equal", i))
    judged = judged.select("*", count(F.col("equal")).alias("matched"), own.alias("own"))
    whole_stretch = (F.col("length") >= STRETCH) & (F.size("own") >= STRETCH_SHARE * F.col("length"))
    part = F.exists(places, lambda i: (i + STRETCH <= F.col("n")) & (count(F.slice("equal", i + 1, STRETCH)) >= STRETCH_SHARE * STRETCH))
    best = (
        judged.groupBy("key", "text_id", "item", "n")
        .agg(
            F.max(F.struct("matched", (-F.col("shift")).alias("back"))).alias("best"),
            F.max(whole_stretch | part).alias("stretch"),
            F.size(F.array_distinct(F.flatten(F.collect_set("own")))).alias("together"),
        )
        .withColumn("matched", F.greatest("best.matched", "together"))
        .filter(F.col("stretch") | (F.col("matched") >= F.when(F.col("n") < SPAN, SHORT_COVERAGE).otherwise(COVERAGE) * F.col("n")))
    )
    return best.select(
        F.col("key").alias(key),
        "text_id",
        F.col("item").alias(item),
        F.col("n").alias("item_words"),
        F.col("matched").alias("matched_words"),
        (F.col("matched") / F.col("n")).alias("coverage"),
        (-F.col("best.back")).alias("at"),
    )


def clean(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that hold no benchmark passage, all columns as they are."""
    found = stored(overlaps(df, benchmark, key, text).select(F.col(key).alias("bad_key"), F.col("text_id").alias("bad_text")).distinct(), "leaks")
    same = (F.xxhash64(whole_text(text)) == F.col("bad_text")) & F.col(key).eqNullSafe(F.col("bad_key"))
    return df.join(found, same, "leftanti")
