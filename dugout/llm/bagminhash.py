"""Near duplicates by weighted Jaccard over word shingles: BagMinHash, bands, verified links.

A text is the multiset of its runs of five words (lower case, punctuation left
out). A shingle that occurs c times owns the weights (0, c], cut at 1, 2, 4, ...;
each cut is a Poisson process of points in time, seeded by shingle and cut, whose
points lie anywhere in the cut. A text sees the points below its c and deals them
to slots; the earliest point of a slot signs it. Two texts agree in a slot with
the probability of their weighted Jaccard similarity, and a process stops as soon
as its next point comes after the latest slot's first.

Slots are joined to bands. Texts that share a band are candidates; every link is
then checked on the whole multisets. Equal texts are one node from the start.
In a bucket every text is first compared with two of its members drawn by hash, so
that a large group of copies becomes one class with as many checks as members.
Members that are in different classes after that meet by prefixes: each orders its
shingles by rarity, and two of similarity 0.8 share one among the first fifth of
both. What lies behind the place where they meet bounds what they share. Both bounds
are exact, and copies whose edits are their own meet nowhere near enough to the front.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import stored, whole_text

WORDS = 5
THRESHOLD = 0.8
SLOTS = 128
#: Slots per band: texts of similarity 0.8 share none of the 32 bands once in 20 million pairs.
ROWS = 4

#: Text bytes signed at once.
CHUNK = 1 << 20

_WORD = re.compile(r"\w+").findall
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, ascending, and how often each occurs.

    A text of fewer than five words is one shingle; one without words has none.
    """
    words = _WORD(text.lower())
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    count = len(words) - width + 1
    rolled = np.full(count, width, np.uint64)
    for k in range(width):
        rolled = _mix(rolled + _GOLD) ^ hashes[k : k + count]
    return np.unique(_mix(rolled), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets; 0 if either is empty."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][left], b[1][right]).sum())
    either = int(a[1].sum() + b[1].sum()) - both
    return both / either if either else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """Signature rows of the multisets; empty ones get zeros."""
    first = np.full((len(bags), slots), np.inf)
    owner = np.zeros((len(bags), slots), np.uint64)
    if not bags:
        return owner
    doc = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    shingle = np.concatenate([b[0] for b in bags])
    weight = np.concatenate([b[1] for b in bags]).astype(np.float64)
    # The processes: (0, 1] for all, then (1, 2], (2, 4], ... as far as a weight reaches.
    seeds, docs, rates, shares = [_mix(shingle + _GOLD)], [doc], [np.ones(len(doc))], [np.ones(len(doc))]
    low, cut = 1.0, 1
    while (deep := weight > low).any():
        cut += 1
        shingle, doc, weight = shingle[deep], doc[deep], weight[deep]
        seeds.append(_mix(shingle + np.array(cut, np.uint64) * _GOLD))
        docs.append(doc)
        rates.append(np.full(len(doc), low))
        shares.append(np.minimum(1.0, (weight - low) / low))
        low *= 2
    seed, doc, rate, share = map(np.concatenate, (seeds, docs, rates, shares))
    time = np.zeros(len(seed))
    flat_first, flat_owner = first.reshape(-1), owner.reshape(-1)
    step = 0
    while len(seed):
        step += 1
        draw = _mix(seed ^ _mix(np.full(1, step, np.uint64) * _GOLD))
        time = time - np.log1p(-((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / rate
        other = _mix(draw + _GOLD)
        place = (other >> np.uint64(40)).astype(np.float64) * 2.0**-24
        at = doc * slots + (other & np.uint64(0xFFFFFFFF)).astype(np.int64) % slots
        hit = np.flatnonzero((place < share) & (time < flat_first[at]))
        hit = hit[np.argsort(-time[hit], kind="stable")]  # of several in a slot the earliest is put down last
        flat_first[at[hit]] = time[hit]
        flat_owner[at[hit]] = draw[hit]
        going = time < first.max(axis=1)[doc]
        seed, doc, rate, share, time = seed[going], doc[going], rate[going], share[going], time[going]
    return owner


def _bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to (node, bands): one 64-bit hash per band, none for a text without words."""

    def signed(nodes: list, bags: list) -> pa.RecordBatch:
        owner = signatures(bags)
        key = np.broadcast_to(np.arange(SLOTS // ROWS, dtype=np.uint64), (len(bags), SLOTS // ROWS))
        for k in range(ROWS):
            key = _mix(key + _GOLD) ^ owner[:, k::ROWS]
        rows = [r.tolist() if len(b[0]) else [] for r, b in zip(_mix(key).view(np.int64), bags, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(rows, pa.list_(pa.int64()))], ["node", "bands"])

    nodes, bags, size = [], [], 0
    for batch in batches:
        for node, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            nodes.append(node.as_py())
            bags.append(shingles(text))
            size += len(text)
            if size >= CHUNK:
                yield signed(nodes, bags)
                nodes, bags, size = [], [], 0
    if nodes:
        yield signed(nodes, bags)


def _checked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) to the pairs that reach the threshold."""
    last, bag = None, None
    for batch in batches:
        a, b = [], []
        for left, right, text_a, text_b in zip(*batch.columns, strict=True):
            left = left.as_py()
            if left != last:
                last, bag = left, shingles(text_a.as_py())
            if similarity(bag, shingles(text_b.as_py())) >= THRESHOLD:
                a.append(left)
                b.append(right.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to (node, size, shingle, n): a row for each distinct shingle; size is that of the multiset."""
    for batch in batches:
        for node, text in zip(batch.column(0), batch.column(1), strict=True):
            hashes, counts = shingles(text.as_py())
            n = len(hashes)
            columns = [pa.array([node.as_py()] * n, pa.binary()), pa.array(np.full(n, counts.sum())), pa.array(hashes.view(np.int64)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "size", "shingle", "n"])


def prefixes(texts: DataFrame) -> DataFrame:
    """``node``, ``size`` of its multiset, ``shingle`` and ``place``: the rarest shingles of each text.

    Shingles are ordered by the number of texts that have them; a shingle that occurs c times
    takes c places, and only its first one counts. Two texts of similarity ``THRESHOLD`` share a
    shingle whose place is within both prefixes: with fewer shared, one of them would lack more
    than it may. Shingles of one text alone take their places and are then left out.
    """
    rows = stored(texts.mapInArrow(_counted, "node binary, size bigint, shingle bigint, n bigint"), "shingles")
    spread = rows.groupBy("shingle").agg(F.count("*").alias("texts")).filter("texts > 1")
    # Shingles of one text come first in it, so they need no order: they are what is not common.
    own = Window.partitionBy("node")
    upto = own.orderBy("texts", "shingle").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    common = rows.join(spread, "shingle").withColumns({"upto": F.sum("n").over(upto), "common": F.sum("n").over(own)})
    placed = common.withColumn("place", F.col("size") - F.col("common") + F.col("upto") - F.col("n"))
    length = F.col("size") - F.ceil(F.col("size") * THRESHOLD - 1e-6) + 1
    return placed.filter(F.col("place") < length).select("node", "size", "shingle", "place")


def meeting(prefix: DataFrame) -> DataFrame:
    """Pairs (a, b) of different labels, a before b, that may reach the threshold; ``prefix`` has a ``label`` too.

    Where two texts meet first, they share no more than what lies from there on.
    """
    left = prefix.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("node", "label", "size", "place")])
    right = prefix.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("node", "label", "size", "place")])
    most = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    enough = most >= (F.col("size_a") + F.col("size_b")) * (THRESHOLD / (1 + THRESHOLD)) - 1e-6
    met = left.join(right, "shingle").filter((F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & enough)
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose texts reach the threshold. The texts of ``a`` come last and are not moved again."""
    of_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = of_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_checked, "a binary, b binary")


def roots(edges: DataFrame) -> DataFrame:
    """(node, label): every node hooked to the smallest node around it if that is smaller, and followed to where that leads.

    Labels are replaced by their label's label until none changes, so that a chain of
    hooks is halved each time. Each step is written to the shared folder.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = stored(labels.join(jump, "label").select("node", F.col("next").alias("label"), F.col("label").alias("was")), "labels")
        if after.filter("label != was").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def relabelled(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges (a, b) between the labels of their ends, once each, a before b; those inside a label are gone."""
    of_a = edges.join(labels.select(F.col("node").alias("a"), F.col("label").alias("label_a")), "a")
    both = of_a.join(labels.select(F.col("node").alias("b"), F.col("label").alias("label_b")), "b").filter("label_a != label_b")
    return both.select(F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")).distinct()


def renamed(labels: DataFrame, over: DataFrame) -> DataFrame:
    """(node, label) with labels replaced by what ``over`` calls them, where it does."""
    to = over.select(F.col("node").alias("label"), F.col("label").alias("to"))
    return stored(labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that a node is linked with, directly or not.

    A round hooks the nodes and leaves only edges between different roots, each once:
    the links of a group are read once and not again in every round, and at most half
    of the nodes that still have edges remain.
    """
    edges = stored(edges.select("a", "b").filter("a != b").distinct(), "edges")
    labels = roots(edges)
    found = labels
    while not (edges := stored(relabelled(edges, labels), "edges")).isEmpty():
        labels = roots(edges)
        found = renamed(found, labels)
    return found


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key`` and ``class_id``, the smallest key of its class.

    Texts are linked when their multisets of five-word shingles have a weighted
    Jaccard similarity of 0.8 or more, or when they are equal; a class is what
    links connect. Null and empty texts are equal texts. Rows without a key get
    no class and count for none; repeated rows stay.
    """
    node = F.unhex(F.md5(whole_text(text))).alias("node")
    rows = df.select(F.col(key).alias("key"), node, whole_text(text).alias("text")).filter("key is not null")
    signed = rows.select("node", "text").mapInArrow(_bands, "node binary, bands array<bigint>")
    keys = rows.groupBy("node").agg(F.min("key").alias("key"))
    slim = signed.select("node", F.posexplode("bands").alias("band", "hash")).distinct()
    buckets = stored(slim, "buckets")

    # Buckets with several texts, and two members of each drawn by hash.
    draw = F.xxhash64("node")
    centres = (
        buckets.groupBy("band", "hash")
        .agg(F.count("*").alias("n"), F.min_by("node", draw).alias("c0"), F.max_by("node", draw).alias("c1"))
        .filter("n > 1")
    )
    shared = stored(buckets.join(centres, ["band", "hash"]).select("band", "hash", "node", "c0", "c1"), "shared-bands")
    ends = shared.select("node", F.explode(F.array("c0", "c1")).alias("centre")).filter("node != centre")
    # The drawn member stands left: its pairs come one after the other and its text is cut once.
    tested = stored(
        ends.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "pairs"
    )
    # One row of each node, by its smallest key: copies don't meet in a task.
    needed = shared.select("node").distinct().join(keys, "node")
    texts = stored(rows.join(needed, ["node", "key"], "leftsemi").dropDuplicates(["node"]).select("node", "text"), "texts")
    links = stored(_verified(tested, texts), "links")
    labels = components(links)

    # Members of a bucket that are still apart meet by their rarest shingles, unless compared before.
    marked = shared.select("band", "hash", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_buckets = marked.groupBy("band", "hash").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi")
    apart = stored(marked.join(open_buckets.select("band", "hash"), ["band", "hash"]).select("node", "label").distinct(), "apart")
    prefix = prefixes(texts.join(apart.select("node"), "node", "leftsemi")).join(apart, "node")
    rest = meeting(stored(prefix, "prefixes"))
    seen = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = stored(_verified(rest.join(seen, ["a", "b"], "leftanti"), texts), "links")
    if not more.isEmpty():
        # Classes are merged, not found again: the links that made them are not read any more.
        labels = renamed(labels.unionByName(apart).distinct(), components(relabelled(more, apart)))

    named = keys.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("key").alias("class_id"))
    classes = named.join(least, "label").select("node", "class_id")
    found = df.select(F.col(key).alias("key"), node).join(classes, "node", "left")
    return found.select(F.col("key").alias(key), F.when(F.col("key").isNotNull(), F.col("class_id")).alias("class_id"))
