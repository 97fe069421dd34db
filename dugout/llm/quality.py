"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of the whole text come from one Arrow function. Boosted trees on a
bounded labelled sample propose rules: every path from a root is a conjunction of
comparisons. A lasso logistic regression weighs the rules and leaves most at zero;
what remains is compiled into one Spark column expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from dugout.llm.common import whole_text
from dugout.llm.trees import boost, sigmoid

#: Most labelled rows that are learnt from, those whose hash is smallest.
SAMPLE_ROWS = 20_000

STATISTICS = (
    "log_chars", "upper_share", "symbol_share", "pipe_share", "shout_share", "digit_share", "stop_share", "comma_share", "space_share", "accent_share",
    "word_length", "distinct_words", "top_word_share", "repeat_share", "lines", "distinct_lines", "line_end_share", "capital_words", "symbol_words", "short_words",
)
_SYMBOLS = np.frombuffer(b"#$%&*+<=>@[\\]^_`{|}~", np.uint8)


def statistics(text: str) -> tuple[float, ...]:
    """The statistics of a text; shares of nothing are 0."""
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size = max(1, len(text))
    words = text.split()
    count = max(1, len(words))
    kinds = {}
    for word in words:
        kinds[word] = kinds.get(word, 0) + 1
    lines = [line for line in text.split("\n") if line.strip()]
    letters = max(1, int(raw[65:91].sum() + raw[97:123].sum()))
    return (
        math.log1p(len(text)),
        raw[65:91].sum() / letters,
        raw[_SYMBOLS].sum() / size,
        raw[124] / size,
        (raw[33] + raw[63]) / size,
        raw[48:58].sum() / size,
        raw[46] / size,
        raw[44] / size,
        (raw[32] + raw[10] + raw[9]) / size,
        raw[128:].sum() / size,
        len(text) / count,
        len(kinds) / count,
        max(kinds.values(), default=0) / count,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / count,
        math.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        sum(line.rstrip()[-1] in ".!?:;" for line in lines) / max(1, len(lines)),
        sum(n for w, n in kinds.items() if w[0].isupper()) / count,
        sum(n for w, n in kinds.items() if not w[-1].isalnum() and w[-1] not in ".,;:") / count,
        sum(n for w, n in kinds.items() if len(w) < 3) / count,
    )


@F.pandas_udf(StructType([StructField(name, DoubleType()) for name in STATISTICS]))
def _statistics_of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = np.array([statistics(t) for t in batch], float).reshape(-1, len(STATISTICS))
        yield pd.DataFrame(rows, columns=list(STATISTICS))


def with_statistics(df: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    return df.withColumn(name, _statistics_of(whole_text(text)))


@dataclass
class Rules:
    """Conjunctions of (statistic, whether at most, bound), their weights and the constant."""

    bias: float
    rules: list[tuple[tuple[tuple[int, bool, float], ...], float]]

    def score(self, statistics: Column) -> Column:
        """Probability of the good class as a column expression."""
        total = F.lit(self.bias)
        for tests, weight in self.rules:
            holds = None
            for j, at_most, bound in tests:
                field = statistics[STATISTICS[j]]
                test = field <= bound if at_most else field > bound
                holds = test if holds is None else holds & test
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The same over an array."""
        return sigmoid(self.bias + sum((w * _holds(x, tests) for tests, w in self.rules), np.zeros(len(x))))


def _holds(x: np.ndarray, tests) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, at_most, bound in tests:
        out &= (x[:, j] <= bound) == at_most
    return out


def _lasso(design: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an absolute penalty, by accelerated proximal steps."""
    n = weight.sum()
    step = 1 / max(1e-9, 0.25 * np.linalg.norm(design * np.sqrt(weight / n)[:, None], 2) ** 2 + 0.25)
    w, b, ahead_w, ahead_b, t = np.zeros(design.shape[1]), 0.0, np.zeros(design.shape[1]), 0.0, 1.0
    for _ in range(rounds):
        off = (sigmoid(design @ ahead_w + ahead_b) - y) * weight / n
        new = ahead_w - step * (design.T @ off)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = ahead_b - step * off.sum()
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead_w, ahead_b = new + (t - 1) / nt * (new - w), new_b + (t - 1) / nt * (new_b - b)
        w, b, t = new, new_b, nt
    return b, w


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 5e-4) -> Rules:
    """Rules for the rows of statistics ``x`` and labels 0 or 1; with one class only, its share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not 0 < y.sum() < len(y):
        return Rules(math.log(share / (1 - share)), [])
    trees = boost(x, y, rounds=30, depth=3, rate=0.3).trees
    paths = sorted({tuple(path) for tree in trees for path in tree.paths()})
    seen: dict[bytes, int] = {}
    for i, path in sorted(enumerate(paths), key=lambda p: (len(p[1]), p[1])):
        seen.setdefault(np.packbits(_holds(x, path)).tobytes(), i)  # of rules that hold for the same rows the shortest
    paths = [paths[i] for i in sorted(seen.values())]
    design = np.stack([_holds(x, p) for p in paths], axis=1).astype(float)
    bias, weights = _lasso(design, y, np.ones(len(y)), penalty)
    return Rules(bias, [(p, float(w)) for p, w in zip(paths, weights, strict=True) if abs(w) > 1e-6])


def fit_on(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> Rules:
    """Rules learnt from labelled documents whose crc32(key as text) mod 5 is not 0, at most ``rows`` of them.

    Labels that are null or belong to no document count for nothing. The statistics
    of the text alone are learnt from.
    """
    learnt = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    learnt = learnt.filter(F.col("key").isNotNull() & F.col("label").isin(0, 1) & ~held_out("key"))
    sample = learnt.groupBy("key").agg(F.max("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(rows)
    texts = df.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(sample), "key")  # a bounded number of keys
    found = with_statistics(texts).select("key", "label", "statistics.*").orderBy("key", *STATISTICS).toPandas()
    return fit(found[list(STATISTICS)].to_numpy(float), found["label"].to_numpy(float))


def held_out(key: str = "doc_id") -> Column:
    """Rows kept for measuring; a null key counts as held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def scored(df: DataFrame, rules: Rules, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """All rows and columns with ``score`` (0 to 1) and ``predicted`` (1 if the score reaches the threshold).

    Columns of these names, and one named ``statistics``, are replaced. Null texts
    count as empty and are scored like them.
    """
    found = with_statistics(df, text).withColumn("score", rules.score(F.col("statistics")))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("statistics")
