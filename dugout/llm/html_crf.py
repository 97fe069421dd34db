"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: the text between two tags that are not inline.
Each block has features of its ancestors (tag names, words of their class, id and
role) and of its text; neighbouring labels have transition weights. The weights
are fitted on a bounded sample of labelled pages by maximum likelihood, and a page
is labelled by Viterbi's algorithm. Nothing of a page is cut off.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dugout.llm.common import per_row, sampled

#: Pages that the fit looks at, and how much of each: its first blocks, and their text in characters.
SAMPLE_PAGES = 300
SAMPLE_BLOCKS = 400
SAMPLE_CHARS = 20_000

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never page text; those of raw text are skipped by the pattern below.
HIDDEN = frozenset("noscript template svg object select button".split())
#: Words of class, id and role that the model knows.
HINTS = frozenset(
    "ad ads advert advertisement sponsor sponsored promo banner sidebar menu nav navigation navbar breadcrumb breadcrumbs footer header "
    "masthead comment comments reply replies disqus cookie cookies consent notice alert popup modal newsletter subscribe signup login share "
    "social related recommended widget pagination pager toolbar copyright legal content main article post entry story body text".split()
)
TAGS = frozenset("article main nav header footer aside form section div ul ol li table td th tr p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption dl dt dd fieldset label details summary address menu dialog body".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|iframe)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_MAY_HIDE = re.compile(r"hidden|none", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDING_STYLE = re.compile(r"(?:\A|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|\Z)", re.I)
#: Elements that may stand in a head; any other ends it, as text does.
_IN_HEAD = frozenset("head html base basefont bgsound link meta title style script noscript template noframes".split())
_HINT_WORD = re.compile(r"[a-z]+")
#: Words long enough to be told at the start of a compound, as in commentlist.
_COMPOUND = re.compile("|".join(sorted((w for w in HINTS if len(w) >= 7), key=len, reverse=True)))


def _hints(value: str) -> set[str]:
    """The known words of a class, id or role; of a compound, the one that it starts with."""
    words = set(_HINT_WORD.findall(value.lower()))
    return words & HINTS | {m[0] for w in words - HINTS if (m := _COMPOUND.match(w))}


#: Elements that an opening tag of the key ends.
_ENDS = {name: frozenset({"p"}) for name in "p div ul ol dl table section article aside nav header footer form h1 h2 h3 h4 h5 h6 blockquote pre figure main hr address fieldset details menu".split()}
_ENDS |= {"li": frozenset({"li", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}), "tr": frozenset({"tr", "td", "th", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"})}


def _hides(rest: str) -> bool:
    """Whether a tag's attributes hide its element: hidden, aria-hidden=true, or a style that doesn't show it."""
    if not _MAY_HIDE.search(rest):
        return False
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and _HIDING_STYLE.search(value)):
            return True
    return False


def blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """Leaf blocks in page order: ancestors' features from the outermost in, text, share of linked text."""
    found: list[tuple[tuple[str, ...], str, float]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = in_link = hidden = at = 0
    in_head = False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                marks = tuple(m for _, own in stack for m in own)
                found.append((marks, text, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked, in_head
        if in_head and text.strip():
            in_head = False
        if text and not hidden and not in_head:
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    for m in _TOKEN.finditer(page):
        take(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue  # a comment, a declaration, a hidden element with all it holds, or the stub of a tag
        name = name.lower()
        if in_head and not m["end"] and name not in _IN_HEAD:
            in_head = False
        if name in INLINE:
            if name == "a":
                in_link = 0 if m["end"] else 1
            elif name == "br":
                take(" ")
            continue
        if not hidden and name not in HIDDEN:  # what is hidden does not part the text around it
            flush()
            in_link = 0
        if name == "head":
            in_head = not m["end"]
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    hidden -= sum("hidden" in own for _, own in stack[k:])
                    del stack[k:]
                    break
        elif name not in VOID:
            ends = _ENDS.get(name)
            while ends and stack and stack[-1][0] in ends:
                hidden -= "hidden" in stack.pop()[1]
            rest = m["rest"]
            own = [f"<{name}>"] if name in TAGS else []
            if rest:
                words = {w for g in _MARKS.finditer(rest) for w in _hints(g[1] or g[2] or g[3] or "")}
                own += sorted(f".{w}" for w in words)
            if name in HIDDEN or (rest and _hides(rest)):
                if name == "svg" and rest.endswith("/"):
                    continue  # a foreign element may close itself
                own.append("hidden")
                hidden += 1
            stack.append((name, tuple(own)))
    take(page[at:])
    flush()
    return found


def text_features(text: str, linked: float) -> list[str]:
    """Features of a block's own text."""
    words = text.count(" ") + 1
    size = "1" if words < 2 else "4" if words < 5 else "10" if words < 11 else "25" if words < 26 else "60" if words < 61 else "long"
    out = [f"words={size}", "stop" if text[-1] in ".!?:;\"'»”" else "no stop"]
    if linked > 0.7:
        out.append("linked")
    elif linked > 0.2:
        out.append("part linked")
    if "©" in text or "copyright" in text[:200].lower():
        out.append("copyright")
    return out


def features(page: list[tuple[tuple[str, ...], str, float]]) -> list[list[str]]:
    """Feature names of every block; those of an ancestor count once, the innermost is also told apart."""
    out = []
    for marks, text, linked in page:
        own = list(set(marks))
        own += [f"in {m}" for m in marks[-1:]]
        out.append(own + text_features(text, linked) + ["bias"])
    return out


class Model:
    """Weights of the features for the label "main text", and of the four transitions."""

    def __init__(self, weights: dict[str, float], steps: np.ndarray) -> None:
        self.weights = weights
        self.steps = [[float(x) for x in row] for row in steps]

    def scores(self, page: list) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in own) for own in features(page)]

    def labels(self, page: list) -> list[bool]:
        """The likeliest labels, by Viterbi."""
        (oo, on), (no, nn) = self.steps
        back: list[tuple[bool, bool]] = []
        off = on_score = 0.0
        for i, score in enumerate(self.scores(page)):
            if not i:
                off, on_score = 0.0, score
                continue
            from_on = on_score + no > off + oo
            stay_on = on_score + nn > off + on
            back.append((from_on, stay_on))
            off, on_score = (on_score + no if from_on else off + oo), (on_score + nn if stay_on else off + on) + score
        if not page:
            return []
        label = on_score > off
        out = [label]
        for from_on, stay_on in reversed(back):
            label = stay_on if label else from_on
            out.append(label)
        return out[::-1]

    def main_text(self, source: str | None) -> str:
        page = blocks(source or "")
        return " ".join(text for (_, text, _), keep in zip(page, self.labels(page), strict=True) if keep)


def fit(pages: Iterable[tuple[list, list[bool]]], rounds: int = 150, rate: float = 0.3, ridge: float = 0.05) -> Model:
    """Maximum likelihood with a ridge penalty by Adam; pages are (blocks, labels)."""
    pages = [(features(p), y) for p, y in pages if p]
    names = sorted({f for p, _ in pages for own in p for f in own})
    index = {f: i for i, f in enumerate(names)}
    longest = max((len(p) for p, _ in pages), default=0)
    if not longest:
        return Model({}, np.zeros((2, 2)))
    design = np.zeros((len(pages), longest, len(names)), np.float32)
    labels = np.zeros((len(pages), longest), np.int64)
    sizes = np.array([len(p) for p, _ in pages])
    for i, (page, own) in enumerate(pages):
        for t, found in enumerate(page):
            design[i, t, [index[f] for f in found]] = 1
        labels[i, : len(page)] = own
    inside = np.arange(longest) < sizes[:, None]
    pair_inside = inside[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:, :-1][pair_inside], labels[:, 1:][pair_inside]), 1.0)
    target = np.einsum("ptf,pt->f", design, labels * inside)
    weights, steps = np.zeros(len(names)), np.zeros((2, 2))
    moments = [np.zeros(len(names) + 4), np.zeros(len(names) + 4)]
    total = inside.sum()
    for n in range(1, rounds + 1):
        on = design @ weights.astype(np.float32)
        emit = np.stack([np.zeros_like(on), on], axis=2).astype(np.float64)
        emit *= inside[:, :, None]
        ahead = np.zeros((len(pages), longest, 2))
        behind = np.zeros((len(pages), longest, 2))
        ahead[:, 0] = emit[:, 0]
        for t in range(1, longest):
            ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + steps, axis=1) + emit[:, t]
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(steps + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(inside[:, t + 1, None], step, 0.0)
        last = ahead[np.arange(len(pages)), sizes - 1]
        norm = np.logaddexp.reduce(last, axis=1)
        belief = np.exp(ahead + behind - norm[:, None, None])[:, :, 1] * inside
        pairs = ahead[:, :-1, :, None] + steps + (emit + behind)[:, 1:, None, :] - norm[:, None, None, None]
        pairs = (np.exp(np.where(pair_inside[:, :, None, None], pairs, -np.inf))).sum(axis=(0, 1))
        slope = np.concatenate([np.einsum("ptf,pt->f", design, belief) - target, (pairs - seen).reshape(-1)]) / total
        slope += ridge / total * np.concatenate([weights, steps.reshape(-1)])
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        move = rate * (moments[0] / (1 - 0.9**n)) / (np.sqrt(moments[1] / (1 - 0.99**n)) + 1e-8)
        weights -= move[: len(names)]
        steps -= move[len(names) :].reshape(2, 2)
    return Model(dict(zip(names, weights.tolist(), strict=True)), steps)


# --- labelled pages --------------------------------------------------------------------------

_APART = frozenset("<nav> <header> <footer> <aside> <form> <fieldset> <menu> <dialog> .ad .ads .advert .advertisement .sponsor .sponsored .promo .banner .sidebar .menu .nav .navigation .navbar .breadcrumb .breadcrumbs .footer .masthead .comment .comments .reply .replies .disqus .cookie .cookies .consent .notice .alert .popup .modal .newsletter .subscribe .signup .login .share .social .related .recommended .widget .pagination .pager .toolbar .copyright .legal".split())
_INNER = ("<article>", "<main>", ".content", ".main", ".article", ".post", ".entry", ".story")


def marked_labels(page: list) -> list[bool]:
    """Labels of a page whose markup says what is what: inside the article and in nothing set apart."""
    return [any(m in _INNER for m in marks) and not _APART.intersection(marks) for marks, _, _ in page]


#: Where labelled pages put the article, and what they set around and inside it.
CONTAINERS = (
    "<article>{}</article>", "<main>{}</main>", '<main><article class="post">{}</article></main>', '<div id="content">{}</div>',
    '<div class="post"><div class="entry">{}</div></div>', '<div class="article"><section>{}</section></div>', '<div id="main"><div>{}</div></div>',
)
ASIDES = (
    "<aside><p>{}</p></aside>", '<div class="sidebar"><p>{}</p></div>', '<div class="ad">{}</div>', '<div class="advert"><p>{}</p></div>',
    '<section class="comments"><p>{}</p></section>', '<div id="comments"><div class="comment"><p>{}</p></div></div>', "<form><label>{}</label></form>",
    '<div class="cookie-notice"><p>{}</p></div>', '<div class="newsletter"><p>{}</p></div>', '<ul class="menu"><li><a href="/">{}</a></li></ul>',
    '<div class="related"><ul><li><a href="/">{}</a></li></ul></div>', '<div class="share">{}</div>', '<div class="banner">{}</div>',
    '<div role="navigation"><a href="/">{}</a></div>', "<header><p>{}</p></header>", "<footer><p>{}</p></footer>", '<div id="footer">{}</div>',
    '<div class="notice"><p>{}</p></div>', '<div class="login"><p>{}</p></div>', '<div class="breadcrumbs"><a href="/">{}</a></div>',
    '<div class="promo sponsored"><p>{}</p></div>', '<div class="pagination"><a href="/">{}</a></div>', "<nav><p>{}</p></nav>",
)


def variants(number: int, page: list) -> list[list]:
    """The blocks of the page itself, and of its article in another container among other surroundings."""
    main = [text for (_, text, _), keep in zip(page, marked_labels(page), strict=True) if keep]
    if not main:
        return [page]
    esc = html.escape
    lines = [f"<p>{esc(t)}</p>" for t in main[:12]]
    lines[0] = f"<h1>{esc(main[0])}</h1>"
    around = [ASIDES[(number * 3 + k) % len(ASIDES)].format(esc(main[k % len(main)])) for k in range(3)]
    inside = ASIDES[(number * 5 + 1) % len(ASIDES)].format(esc(main[-1]))
    lines.insert(1 + number % len(lines), inside)
    body = CONTAINERS[number % len(CONTAINERS)].format("".join(lines))
    return [page, blocks(f"<body>{around[0]}{around[1]}{body}{around[2]}</body>")]


def first_blocks(page: str) -> list:
    """The first blocks of a page, as many as the fit looks at; the last one's text may be cut."""
    found, left = [], SAMPLE_CHARS
    for marks, text, linked in blocks(page)[:SAMPLE_BLOCKS]:
        if left <= 0:
            break
        found.append((marks, text[:left], linked))
        left -= len(text)
    return found


def fit_on(df: DataFrame, column: str = "html", pages: int = SAMPLE_PAGES, label: Callable[[list], list[bool]] = marked_labels) -> Model:
    """A model fitted on a sample of the table.

    The sample is bounded: at most ``pages`` pages, those whose hash is smallest, by their first
    ``SAMPLE_BLOCKS`` blocks of up to ``SAMPLE_CHARS`` characters. ``label`` labels the blocks. Without
    pages, or where no block is labelled as text, the fit goes over built-in pages instead.
    """

    @F.pandas_udf("string")
    def shown(found: pd.Series) -> pd.Series:
        return found.map(lambda page: json.dumps(first_blocks(page)))

    sample = [[(tuple(marks), text, linked) for marks, text, linked in json.loads(p)] for p in sampled(df, column, pages, shown("text"))]
    labelled = [(page, label(page)) for i, source in enumerate(sample) for page in variants(i, source)]
    if not any(any(own) for _, own in labelled):
        labelled += [(page, marked_labels(page)) for i in range(len(ASIDES)) for page in variants(i, blocks(BUILT_IN))]
    return fit(labelled)


#: A page for the case that the table tells nothing.
BUILT_IN = (
    "<article><h1>A plain heading</h1><p>A first paragraph that says something, at some length, about what follows.</p>"
    "<p>A second one, which goes on; it has several clauses, and it ends.</p><ul><li>One point of a list</li></ul><p>The last words of it all.</p></article>"
)


def extract(df: DataFrame, model: Model, column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, ``text`` (the main text; empty if there is none) and ``n_chars`` of every row.

    Null and empty pages have an empty text; repeated rows and nulls in the kept
    columns stay; other columns are not carried.
    """
    names = [f"k{i}" for i in range(len(keep))]
    source = df.select(*[F.col(k).alias(n) for k, n in zip(keep, names, strict=True)], F.col(column).cast("string").alias("html"))

    def make(*cells):
        text = model.main_text(cells[-1])
        return (*cells[:-1], text), len(text)

    kinds = [df.schema[k].dataType for k in keep]
    schema = pa.schema([*((n, to_arrow_type(t)) for n, t in zip(names, kinds, strict=True)), ("text", pa.string())])
    fields = ", ".join([*(f"{n} {t.simpleString()}" for n, t in zip(names, kinds, strict=True)), "text string"])
    found = source.mapInArrow(per_row(make, schema), fields)
    return found.select(*[F.col(n).alias(k) for k, n in zip(keep, names, strict=True)], "text", F.length("text").cast("bigint").alias("n_chars"))
