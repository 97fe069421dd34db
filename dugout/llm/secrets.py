"""Secret scan: generous candidates, and a random forest that removes the false ones.

Candidates are private key blocks, runs of key characters that hold a digit, are
long, mix cases or stand after an assignment, and whatever is assigned to a name
with a secret's word in it: all between the quotes, or up to the next white space.
They may overlap; what is found is their union. The forest looks at length and alphabet, how usual the
characters follow each other in the corpus, how much of the candidate known words
cover, whether it is part of a path, and the words around it. Letter steps and
words are counted over all whole texts. The forest is fitted on labelled findings; ``labelled_findings`` makes some by setting secrets and
look-alikes into sentences of a bounded sample of documents.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dugout.llm.common import Output, per_row, row_chunks, sample_texts, stored, whole_text
from dugout.llm.trees import Forest, forest

#: The sample for labelled findings: documents, and the longest of them in characters; words of the dictionary.
SAMPLE_DOCUMENTS = 1_500
SAMPLE_CHARS = 20_000
DICTIONARY_WORDS = 5_000
#: Distinct words, and their characters, counted in a task before the counts are passed on.
PART_WORDS = 200_000
PART_CHARS = 16_000_000
THRESHOLD = 0.5
#: Shortest assigned value in characters.
LEAST_VALUE = 6

_RUN = re.compile(r"(?<!\w)[A-Za-z0-9+/_-]{12,}={0,2}(?!\w)")
_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)", re.S)
_ASSIGNED = re.compile(r"([A-Za-z][A-Za-z0-9_.-]{0,40})[\"']?[ \t]*(?:=>|:=|={1,3}|:)[ \t]*[\"']?\Z")
#: From the mark of an assignment on: a scheme's name, and the value in quotes or up to white space, six characters at least.
_SIGN = re.compile("[:=]")
_VALUE = re.compile(r"(?:=>|:=|={1,3}|:)[ \t]*(?:(?:bearer|basic|token)[ \t]+)?(?:\"([^\"\n]{6,})\"|'([^'\n]{6,})'|[\"']?([^\s\"']\S{5,}))", re.I)
#: Marks of the sentence or list around a value without quotes.
_TRAIL = ".,;:)]}>\"'"
_BEFORE = re.compile(r"([^\W\d_]+)\W*\Z")
_MIXED = re.compile(r"[a-z][A-Z0-9]|[0-9][a-zA-Z]")
_HEX = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_WORD = re.compile(r"[a-z]+")
#: Words that name secrets, and words that name other long identifiers.
SECRET_WORDS = ("secret", "token", "password", "passwd", "pwd", "apikey", "api_key", "key", "auth", "credential", "bearer", "private")
OTHER_WORDS = ("commit", "sha", "md5", "checksum", "hash", "digest", "etag", "id", "uuid", "version", "file", "path", "url", "build", "revision", "class", "isbn", "order", "invoice")
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "sk-", "sk_", "pk_", "xox", "AIza", "glpat-", "eyJ")


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that may be secrets, in order; they may overlap. Private key blocks come as a whole and by their lines."""
    found = {m.span() for m in _BLOCK.finditer(text)} if "-----BEGIN" in text else set()
    for m in _SIGN.finditer(text):
        name = _ASSIGNED.search(text[max(0, m.start() - 50) : m.end()])
        if name and any(w in name[1].lower() for w in SECRET_WORDS) and (value := _VALUE.match(text, m.start())):
            start, end = value.span(value.lastindex)
            if value.lastindex == 3:
                end = start + len(value[3].rstrip(_TRAIL))
            if end - start >= LEAST_VALUE:
                found.add((start, end))
    for m in _RUN.finditer(text):
        start, end = m.span()
        run = m[0]
        plain = run.isalpha() and len(run) < 20 and (run.islower() or run[1:].islower() or run.isupper())
        if not plain or _ASSIGNED.search(text[max(0, start - 50) : start]):
            found.add((start, end))
    return sorted(found)


def _pairs(counts: Counter[str]) -> Counter[str]:
    """How often letters follow each other in counted words."""
    pairs: Counter[str] = Counter()
    for word, n in counts.items():
        for pair in map("".join, zip(word, word[1:], strict=False)):
            pairs[pair] += n
    return pairs


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (item, whether it is a pair of letters, how often): words of three letters or more, and pairs."""
    counts: Counter[str] = Counter()
    pairs: Counter[str] = Counter()
    out = Output(pa.schema([("item", pa.string()), ("pair", pa.bool_()), ("n", pa.int64())]))

    def passed_on(items: Counter[str], pair: bool) -> Iterator[pa.RecordBatch]:
        for item, n in items.items():
            if (pair or len(item) > 2) and out.add((item, pair, n), len(item) + 16):
                yield out.batch()
        items.clear()

    def words() -> Iterator[pa.RecordBatch]:
        pairs.update(_pairs(counts))
        yield from passed_on(counts, False)

    chars = 0
    for (texts,) in row_chunks(batches):
        for text in texts:
            before = len(counts)
            found = _WORD.findall(text.lower())
            counts.update(found)
            if len(counts) > before:
                chars += sum(map(len, set(found)))
            if len(counts) >= PART_WORDS or chars >= PART_CHARS:
                yield from words()
                chars = 0
    yield from words()
    yield from passed_on(pairs, True)
    if out.columns[0]:
        yield out.batch()


@dataclass
class Language:
    """How characters follow each other in the corpus, and its frequent words."""

    steps: dict[str, float]
    words: frozenset[str]

    @classmethod
    def of(cls, texts: list[str], words: int = DICTIONARY_WORDS) -> Language:
        counts: Counter[str] = Counter()
        for text in texts:
            counts.update(_WORD.findall(text.lower()))
        ranked = sorted((w for w in counts if len(w) > 2), key=lambda w: (-counts[w], w))
        return cls.from_counts(_pairs(counts), ranked[:words])

    @classmethod
    def over(cls, df: DataFrame, text: str = "text", words: int = DICTIONARY_WORDS) -> Language:
        """The language of all whole texts; the driver gets the pairs of letters and the frequent words alone."""
        counted = df.select(whole_text(text).alias("text")).mapInArrow(_count, "item string, pair boolean, n bigint")
        counted = stored(counted.groupBy("item", "pair").agg(F.sum("n").alias("n")), "language")
        pairs = {r["item"]: r["n"] for r in counted.filter("pair").collect()}  # 26 * 26 at most
        ranked = counted.filter("not pair").orderBy(F.desc("n"), "item").limit(words).collect()
        return cls.from_counts(pairs, [r["item"] for r in ranked])

    @classmethod
    def from_counts(cls, pairs: dict[str, int], words: list[str]) -> Language:
        first: Counter[str] = Counter()
        for pair, n in pairs.items():
            first[pair[0]] += n
        return cls({p: math.log((n + 0.5) / (first[p[0]] + 20)) for p, n in pairs.items()}, frozenset(words))

    def surprise(self, run: str) -> float:
        """Mean negative log-likelihood of the steps from character to character."""
        lower = run.lower()
        pairs = [a + b for a, b in zip(lower, lower[1:], strict=False)]
        return -sum(self.steps.get(p, -7.0) for p in pairs) / max(1, len(pairs))

    def coverage(self, run: str) -> float:
        """Share of the characters that known words cover, the longest word first at each place."""
        lower, at, covered = run.lower(), 0, 0
        while at < len(lower):
            for size in range(min(14, len(lower) - at), 2, -1):
                if lower[at : at + size] in self.words:
                    covered += size
                    at += size
                    break
            else:
                at += 1
        return covered / max(1, len(run))


def features(text: str, start: int, end: int, language: Language) -> list[float]:
    run = text[start:end]
    size = end - start
    before = text[max(0, start - 50) : start]
    assigned = _ASSIGNED.search(before)
    name = (assigned[1] if assigned else (m[1] if (m := _BEFORE.search(before)) else "")).lower()
    after = text[end : end + 1]
    counts = Counter(run)
    bits = -sum(n / size * math.log2(n / size) for n in counts.values())
    digits = sum(c.isdigit() for c in run)
    upper = sum(c.isupper() for c in run)
    parts = re.split(r"[/_.+=-]+", run)
    return [
        float(size),
        bits,
        bits / math.log2(max(2, size)),
        digits / size,
        upper / size,
        len(_MIXED.findall(run)) / size,
        float(bool(_HEX.match(run))),
        float(size in (32, 40, 64)),
        float(run.isdigit()),
        language.surprise(run),
        language.coverage(run),
        float(run.count("/")),
        float(run.count("-") + run.count("_")),
        max((len(p) for p in parts), default=0) / size,
        float(text[max(0, start - 1) : start] in ("/", ".", "\\")) + float(after in ("/", ".") and text[end + 1 : end + 2].isalnum()),
        float(bool(assigned)),
        float(any(w in name for w in SECRET_WORDS)),
        float(any(w == name or name.endswith("_" + w) for w in OTHER_WORDS)),
        float(text[max(0, start - 1) : start] in ("\"", "'") and after in ("\"", "'")),
        float(run.startswith(PREFIXES)),
        float(run.startswith("-----BEGIN")),
        max(counts.values()) / size,
        sum(not c.isalnum() for c in run) / size,
        sum(c.isspace() for c in run) / size,
        float(run.isalpha()),
        float(run[0] in "$<{%[*" or run.endswith(("(", "()", "...")) or "${" in run or "://" in run),
    ]


_SPELLED = str.maketrans({"a": "@", "e": "3", "i": "1", "o": "0", "s": "$"})


def labelled_findings(texts: list[str], seed: int = 11) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label): secrets and look-alikes set between words of the texts, and words as they are."""
    rng = random.Random(seed)
    lower, hexa, mixed = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    draw = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    out = []
    for text in texts:
        words = text.split()
        if len(words) < 6:
            continue
        at = rng.randrange(len(words) - 4)
        left, right = " ".join(words[max(0, at - 6) : at + 1]), " ".join(words[at + 1 : at + 7])
        plain = [w for w in map(str.lower, words) if w.isascii() and w.isalpha()] or ["word"]
        pick = lambda: rng.choice(plain)  # noqa: E731, B023
        secret = rng.choice(
            [
                lambda: draw(hexa, rng.choice([16, 18, 20, 24, 32, 40, 64])),
                lambda: rng.choice(["AKIA", "ASIA"]) + draw(mixed[:26] + "0123456789", 16),
                lambda: draw(mixed, rng.randrange(16, 48)),
                lambda: draw(mixed + "+/", rng.randrange(24, 64)) + rng.choice(["", "=", "=="]),
                lambda: rng.choice(["ghp_", "sk-", "glpat-", "AIza"]) + draw(mixed, 36),
                lambda: draw(lower + "0123456789", rng.randrange(14, 32)),
            ]
        )()
        password = rng.choice(
            [
                lambda: pick()[:9] + rng.choice(["", rng.choice("!#$.&_-")]) + draw("0123456789", rng.randrange(1, 5)) + draw(mixed + "!#$&", rng.randrange(1, 3)),
                lambda: pick().capitalize().translate(_SPELLED)[:10] + rng.choice("!#$&*.@") + draw("0123456789", rng.randrange(1, 5)),
                lambda: draw(mixed, rng.randrange(7, 12)) + rng.choice("0123456789"),
                lambda: draw(mixed + "!#$%&*+-=?@^_~", rng.randrange(8, 20)) + rng.choice("0123456789") + draw(mixed, 1),
                lambda: pick().translate(_SPELLED)[:8] + rng.choice("!@#$%&") + draw("0123456789", 4) + rng.choice("!#$%&") + draw(lower, 1),
            ]
        )()
        spared = rng.choice(
            [
                pick,
                lambda: pick().capitalize(),
                lambda: " ".join(pick() for _ in range(rng.randrange(2, 7))),
                lambda: rng.choice(["${{{}}}", "<{}>", "{{{{ {} }}}}", "%{}%", "os.environ[{}]", "process.env.{}", "get_{}()", "config.{}", "self.{}", "{}.{}"]).replace("{}", pick()),
                lambda: rng.choice("*xX.") * rng.randrange(6, 14),
                lambda: rng.choice(["changeme", "undefined", "required", "optional", "example", "string", "boolean", "https://" + pick() + ".org/" + pick()]),
            ]
        )()
        fake = rng.choice(
            [
                lambda: "-".join(pick() for _ in range(rng.randrange(3, 6))),
                lambda: "_".join(pick() for _ in range(rng.randrange(3, 6))) + rng.choice(["", str(rng.randrange(1, 2030))]),
                lambda: "/".join(pick() for _ in range(rng.randrange(3, 6))) + "/" + str(rng.randrange(1, 2030)),
                lambda: "".join(w.capitalize() for w in (pick(), pick(), pick(), pick())) + rng.choice(["", "2"]),
                lambda: "".join(pick() for _ in range(rng.randrange(4, 8))),
                lambda: draw("0123456789", rng.randrange(12, 20)),
                lambda: rng.choice("x0*a1") * rng.randrange(14, 40),
                lambda: f"{rng.randrange(1990, 2030)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}T{rng.randrange(10, 24)}",
                lambda: f"your_{pick()}_{rng.choice(['here', 'key', 'token'])}_{pick()}",
            ]
        )()
        name = rng.choice(SECRET_WORDS)
        shell = rng.choice(['{n} = "{v}"', "{n}={v}", "{n}: {v}", "{n} => '{v}'", "my_{n}={v}"])
        for value, label in ((secret, 1), (fake, 0)):
            frame = shell.format(n=name, v=value) if rng.random() < (0.6 if label else 0.35) else rng.choice(["{v}", '"{v}"', "{v},"]).format(v=value)
            made = f"{left} {frame} {right}"
            out.append((made, s := made.index(value), s + len(value), label))
        # What only its assignment proposes: values of any characters, words and stand-ins.
        shell = rng.choice(['{n} = "{v}"', "{n}={v}", "{n}: {v}", "{n} => '{v}'", "my_{n}={v}", '"{n}": "{v}"'])
        for value, label in ((password, 1), (spared, 0), (rng.choice(words[at + 1 :]), 0)):
            made = f"{left} {shell.format(n=name, v=value)} {right}"
            start = made.index(shell.format(n=name, v=value), len(left)) + shell.format(n=name, v="\0").index("\0")
            if (span := (start, start + len(value))) in candidates(made):
                out.append((made, *span, label))
        body = "\n".join(draw(mixed + "+/", 64) for _ in range(rng.randrange(3, 26)))
        prose = " ".join(rng.sample(words, min(len(words), 40)))
        begin, end = (f"-----{w} {rng.choice(['', 'RSA ', 'EC ', 'OPENSSH ', 'ENCRYPTED '])}PRIVATE KEY-----" for w in ("BEGIN", "END"))
        for inner, label in ((body, 1), (prose, 0)) if rng.random() < 0.2 else ():
            value = f"{begin}\n{inner}" + rng.choice([f"\n{end}", ""])
            out.append((f"{left} {value}", len(left) + 1, len(left) + 1 + len(value), label))
        other = rng.choice(OTHER_WORDS)
        value = draw(hexa, rng.choice([32, 40, 64])) if rng.random() < 0.5 else fake
        made = f"{left} {other}{rng.choice([' ', ': ', '='])}{value} {right}"
        out.append((made, s := made.index(value, len(left)), s + len(value), 0))
        natural = [(a, b) for a, b in candidates(text) if text[a:b].isalpha()]
        out += [(text, a, b, 0) for a, b in natural[:3]]
    return out


@dataclass
class Scanner:
    language: Language
    model: Forest
    threshold: float = THRESHOLD

    def spans(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of what the forest takes for secrets: overlapping candidates are one, with the highest."""
        found = candidates(text)
        if not found:
            return []
        x = np.array([features(text, a, b, self.language) for a, b in found])
        out: list[tuple[int, int, float]] = []
        for (a, b), p in zip(found, self.model.predict(x), strict=True):
            if p < self.threshold:
                continue
            if out and a < out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]), max(float(p), out[-1][2]))
            else:
                out.append((a, b, float(p)))
        return out

    def redacted(self, text: str, mark: str = "[SECRET]") -> str:
        for start, end, _ in reversed(self.spans(text)):
            text = text[:start] + mark + text[end:]
        return text


def fit(findings: list[tuple[str, int, int, int]], language: Language) -> Scanner:
    """A scanner fitted on labelled findings (text, start, end, label)."""
    if not findings:
        return Scanner(language, Forest(0.0, []))
    x = np.array([features(t, a, b, language) for t, a, b, _ in findings])
    return Scanner(language, forest(x, np.array([label for *_, label in findings], float)))


def fit_on(df: DataFrame, text: str = "text") -> Scanner:
    """A scanner fitted on findings made from a bounded sample of the texts, with the language of all; without texts it finds nothing."""
    texts = sample_texts(df, text, SAMPLE_DOCUMENTS, SAMPLE_CHARS)
    return fit(labelled_findings(texts), Language.over(df, text))


def scan(df: DataFrame, scanner: Scanner, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_secrets``, ``spans`` (start:end, comma-joined, in code points) and ``score`` (the highest, or null).

    A row per input row; null and empty texts hold none. Nothing of a secret is returned.
    """

    def make(k, body):
        spans = scanner.spans(body)
        joined = ",".join(f"{a}:{b}" for a, b, _ in spans)
        return (k, len(spans), joined, max((p for *_, p in spans), default=None)), 40 + len(joined)

    kind = df.schema[key].dataType
    schema = pa.schema([("key", to_arrow_type(kind)), ("n_secrets", pa.int64()), ("spans", pa.string()), ("score", pa.float64())])
    source = df.select(F.col(key).alias("key"), whole_text(text).alias("body"))
    found = source.mapInArrow(per_row(make, schema), f"key {kind.simpleString()}, n_secrets bigint, spans string, score double")
    return found.withColumnRenamed("key", key)


def redact(df: DataFrame, scanner: Scanner, text: str = "text") -> DataFrame:
    """All rows and columns, with secrets in the text replaced by a mark; null texts stay null."""

    @F.arrow_udf("string")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = (t.as_py() for t in batch)
            yield pa.array([None if t is None else scanner.redacted(t) for t in found], pa.string())

    return df.withColumn(text, clean(F.col(text)))
