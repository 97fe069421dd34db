"""One generic flattener: nested JSON payloads to typed rows.

A plan names the arrays to walk and, per column, where the value lies and its
type. From the plan follows the schema each level is parsed with: only what a
column or the next level needs, leaves as text. Elements come out of arrays as
text and are parsed one by one, so an element that is no object is skipped
without losing its neighbours, and objects are never assumed to be there. Any
number of payloads is flattened in one job, row by row, without a shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.errors import InvalidParameter
from dugout.operators.names import once, ref, refs, types_of

PROBLEMS = "_problems"
ROOT = "payload"
WHOLE = "$"
LIST = "array<string>"
OBJECT = "map<string,string>"


@dataclass(frozen=True)
class Step:
    """Explode ``path`` of an earlier level into one row per object, called ``level``.

    ``keyed`` walks the values of an object instead of a list, ``keys`` only
    those under the given names.
    """

    level: str
    parent: str
    path: str = "$"
    keyed: bool = False
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class Plan:
    """Levels to walk and columns to read.

    A column is ``name: (type, place, ...)``. A place is ``level:path`` inside a
    payload or ``@name`` for a request parameter; the first place with a value
    wins. ``required`` columns must not be null.
    """

    steps: tuple[Step, ...]
    columns: dict[str, tuple[str, ...]]
    required: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)


def json_schema(leaves: dict[str, str], between: str = " ") -> str:
    """Schema text for dotted paths: ``{"a.b": "string"}`` to ``a struct<b: string>``."""
    tree: dict = {}
    for path, kind in leaves.items():
        node = tree
        *parents, leaf = path.split(".")
        for part in parents:
            node = node.setdefault(part, {})
            if not isinstance(node, dict):
                raise InvalidParameter(f"{path!r} lies below a value that is read as a whole.")
        if leaf in node and node[leaf] != kind:
            raise InvalidParameter(f"{path!r} is read in two ways.")
        node[leaf] = kind

    def text(node: dict, between: str) -> str:
        return ", ".join(
            f"`{name}`{between}{below if isinstance(below, str) else 'struct<' + text(below, ': ') + '>'}"
            for name, below in node.items()
        )

    return text(tree, between)


def parsed(text: Column, leaves: dict[str, str]) -> Column:
    """JSON text as a struct of the given paths."""
    return F.from_json(text, json_schema(leaves))


def field_at(name: str, path: str) -> Column:
    """Field of a parsed struct column by its dotted path."""
    return F.col(".".join(f"`{part}`" for part in [name, *path.split(".")]))


def is_object(text: Column) -> Column:
    return F.startswith(text, F.lit("{"))


def objects(text: Column) -> Column:
    """Objects of a JSON list, or of the values of a JSON object, as texts."""
    values = F.when(is_object(text), F.map_values(F.from_json(text, OBJECT))).otherwise(F.from_json(text, LIST))
    return F.filter(values, is_object)


def walk(
    payloads: DataFrame,
    steps: Sequence[Step],
    wanted: dict[str, dict[str, str]],
    body: str = "body",
) -> DataFrame:
    """Payload columns plus one column ``level:path`` per wanted value.

    Levels form a chain. As many of them as possible are parsed together, with one schema that
    holds the wanted values of all; a level that is wanted as a whole starts from its own text.
    """
    chain = _chain(steps, wanted)
    rows = payloads.select(*[ref(c) for c in payloads.columns if c != body], ref(body).alias("_text"))
    while chain:
        size = 1
        while size < len(chain) and not chain[size - 1].from_text and not chain[size].from_text:
            size += 1
        rows = _from_text(rows, chain[0]) if chain[0].from_text else _together(rows, chain[:size])
        chain = chain[size:]
    return rows.drop("_text")


@dataclass(frozen=True)
class _Level:
    name: str
    leaves: dict[str, str]
    step: Step | None

    @property
    def from_text(self) -> bool:
        """Whether the level's text is needed: as a value, or because the next level is all of it."""
        return WHOLE in self.leaves or (self.step is not None and self.step.path == WHOLE)


def _chain(steps: Sequence[Step], wanted: dict[str, dict[str, str]]) -> list[_Level]:
    levels = [ROOT, *[s.level for s in steps]]
    for level, step in zip(levels, steps, strict=False):
        if step.parent != level:
            raise InvalidParameter(f"Level {step.level!r} must follow {step.parent!r} directly.")
    return [_Level(level, dict(wanted.get(level, {})), step) for level, step in zip(levels, [*steps, None], strict=True)]


def _from_text(rows: DataFrame, level: _Level) -> DataFrame:
    """Read one level from its text and go down to the texts of the next."""
    carried = [c for c in rows.columns if c != "_text"]
    leaves, step = dict(level.leaves), level.step
    if step is not None:
        leaves[step.path] = _texts_below(step)
    whole = leaves.pop(WHOLE, None)
    if leaves:
        rows = once(rows, _doc=parsed(F.col("_text"), leaves))
    values = [field_at("_doc", path).alias(f"{level.name}:{path}") for path in leaves]
    if whole:
        rows = once(rows, _whole=F.from_json("_text", whole))
        values.append(F.col("_whole").alias(f"{level.name}:{WHOLE}"))
    rows = rows.select(*refs(carried), *values)
    return rows if step is None else _descend(rows, step, ref(f"{step.parent}:{step.path}"), is_object)


def _together(rows: DataFrame, chain: Sequence[_Level]) -> DataFrame:
    """Read levels that follow each other with one schema; the last goes down to texts if there is a next.

    Where a list holds something that is no object, Spark gives no list at all. Such payloads are told
    by their report and read again, element by element.
    """
    carried = [c for c in rows.columns if c != "_text"]
    rows = once(rows, _doc=_reported(F.col("_text"), chain))
    at, here = "_doc", lambda path: field_at(at, path)
    for k, level in enumerate(chain):
        values = [here(path).alias(f"{level.name}:{path}") for path in level.leaves]
        if level.step is None:
            return rows.select(*refs(carried), *values)
        below = here(level.step.path)
        inner = k + 1 < len(chain)
        if inner and k == 0:
            gaps = F.col(f"{at}.{REPORT}").isNotNull() & _has_gap(below, chain[1:], level.step)
            below = F.when(gaps, _one_by_one(F.col("_text"), chain)).otherwise(below)
        rows = rows.select(*refs(carried), *values, below.alias("_below"))
        carried += [f"{level.name}:{path}" for path in level.leaves]
        carried += [f"{level.step.level}_key"] if level.step.keyed else []
        rows = _descend(rows, level.step, F.col("_below"), Column.isNotNull if inner else is_object)
        if inner:
            rows = rows.withColumnRenamed("_text", "_doc")
    return rows


#: Where Spark reports what it could not read of a payload.
REPORT = "_unreadable"


def _reported(text: Column, chain: Sequence[_Level]) -> Column:
    """All levels of a payload, and Spark's report."""
    schema = f"{json_schema(_schema_leaves(chain))}, {REPORT} string"
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": REPORT})


def _texts_below(step: Step) -> str:
    return OBJECT if step.keyed else LIST


def _schema_leaves(chain: Sequence[_Level]) -> dict[str, str]:
    """Leaves of the first level, with the next levels as the type of its list or object."""
    level, *rest = chain
    leaves = dict(level.leaves)
    if level.step is not None:
        inner = f"struct<{json_schema(_schema_leaves(rest), ': ')}>" if rest else "string"
        leaves[level.step.path] = f"map<string,{inner}>" if level.step.keyed else f"array<{inner}>"
    return leaves


def _has_gap(below: Column, rest: Sequence[_Level], step: Step) -> Column:
    """Whether a list is missing at this level or further down."""
    level, *more = rest
    if level.step is None or not more:
        return below.isNull()
    items = F.map_values(below) if step.keyed else below
    inner = F.exists(items, lambda e: F.coalesce(_has_gap(inside(e, level.step.path), more, level.step), F.lit(False)))
    return below.isNull() | F.coalesce(inner, F.lit(False))


def inside(value: Column, path: str) -> Column:
    for part in path.split("."):
        value = value[part]
    return value


def _one_by_one(text: Column, chain: Sequence[_Level]) -> Column:
    """What lies below the first level, each element parsed alone; those that are no objects are left out."""
    level, *rest = chain
    path, keyed = level.step.path, level.step.keyed
    found = inside(parsed(text, {path: _texts_below(level.step)}), path)

    def element(item: Column) -> Column:
        below = rest[0]
        if below.step is None:
            return parsed(item, below.leaves) if below.leaves else F.struct()
        own = parsed(item, {**below.leaves, below.step.path: _texts_below(below.step)})
        if len(rest) == 1:
            return own
        return _bound(own, lambda d: d.withField(_quoted(below.step.path), _one_by_one(item, rest)))

    if keyed:
        return F.transform_values(F.map_filter(found, lambda k, v: is_object(v)), lambda k, v: element(v))
    return F.transform(F.filter(found, is_object), element)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a costly value, which is made once however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _quoted(path: str) -> str:
    return ".".join(f"`{part}`" for part in path.split("."))


def _rows_below(items: Column, chain: Sequence[_Level], row, wanted, above: dict[str, Column]) -> Column:
    """What ``row`` makes of the values of all levels, for every wanted element of the last, as one list."""
    level, *rest = chain
    here = lambda e: {**above, **{f"{level.name}:{path}": inside(e, path) for path in level.leaves}}
    if level.step is None:
        return F.transform(F.filter(items, lambda e: e.isNotNull() & wanted(here(e))), lambda e: row(here(e)))
    below = lambda e: inside(e, level.step.path)
    return F.flatten(F.transform(F.filter(items, lambda e: below(e).isNotNull()), lambda e: _rows_below(below(e), rest, row, wanted, here(e))))


def _is_endless(node: Column, chain: Sequence[_Level]) -> Column:
    """Whether a number here or further down is none or too large for its type."""
    level, *rest = chain
    found = [F.abs(inside(node, path)) > F.lit(sys.float_info.max) for path, kind in level.leaves.items() if kind == "double"]
    if rest:
        found.append(F.exists(inside(node, level.step.path), lambda e: _is_endless(e, rest)))
    return reduce(or_, [F.coalesce(f, F.lit(False)) for f in found], F.lit(False))


def _descend(rows: DataFrame, step: Step, source: Column, real) -> DataFrame:
    """One row per element of a list or value of an object; the element is called ``_text``."""
    gone = {"_text", "_doc", "_below", f"{step.parent}:{step.path}"}
    others = refs(c for c in rows.columns if c not in gone)
    names = [f"{step.level}_key", "_text"] if step.keyed else ["_text"]
    below = rows.select(*others, F.explode(source).alias(*names)).where(real(F.col("_text")))
    return below.where(ref(f"{step.level}_key").isin(*step.keys)) if step.keys else below


def unparsed(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Payloads whose body is no JSON, which no plan gets a row from."""
    return payloads.where(ref(body).isNotNull() & F.try_parse_json(ref(body)).isNull())


def places_of(columns: dict[str, tuple[str, ...]]) -> dict[str, dict[str, str]]:
    """Values to read per level, for the places of some columns."""
    wanted: dict[str, dict[str, str]] = {}
    for _, *places in columns.values():
        for place in places:
            level, _, path = place.partition(":")
            if not place.startswith("@") and path != "#key":
                wanted.setdefault(level, {})[path] = "string"
    return wanted


def read_place(place: str, have: Sequence[str]) -> Column:
    """Text of a place; a request parameter is a column or an entry of ``params``."""
    if place.startswith("@"):
        name = place[1:]
        if name in have:
            return ref(name).cast("string")
        if "params" in have:
            return F.try_element_at(ref("params"), F.lit(name))
        raise InvalidParameter(f"Payloads carry no request parameter {name!r}.")
    level, _, path = place.partition(":")
    return ref(f"{level}_key") if path == "#key" else ref(place)


def to_type(text: Column, kind: str) -> Column:
    """Text to a declared type; whole numbers may come with a fraction of zero."""
    if kind == "string":
        return text
    if kind == "bigint":
        cut = F.regexp_replace(text, r"^([+-]?[0-9]+)\.0+$", "$1")
        return F.when(F.contains(text, F.lit(".")), cut).otherwise(text).try_cast("bigint")
    return text.try_cast(kind)


def _texts(plan: Plan, have: Sequence[str]) -> dict[str, Column]:
    return {
        name: F.coalesce(*[read_place(p, have) for p in places], F.lit(plan.defaults.get(name)).cast("string"))
        for name, (_, *places) in plan.columns.items()
    }


def _raw(payloads: DataFrame, plan: Plan, body: str, only: Column | None) -> DataFrame:
    """Texts of all columns."""
    rows = walk(payloads, plan.steps, places_of(plan.columns), body)
    raw = rows.select(*[text.alias(name) for name, text in _texts(plan, payloads.columns).items()])
    return raw if only is None else raw.where(only)


def _raw_plain(payloads: DataFrame, plan: Plan, body: str, only: str | None) -> DataFrame:
    """Request columns, and those of the payload as ``_values`` of their types or as ``_words``, one of them null.

    Numbers and flags that come as such are read with their types, instead of becoming texts that are
    cast. Only payloads that Spark reports, or with endless numbers, are read again, as texts. All rows
    of a payload come out of one generator.
    """
    asked = _asked(plan)
    found = {name: column for name, column in plan.columns.items() if name not in asked}
    kinds = {place: kind for kind, place in found.values()}
    words = _chain(plan.steps, places_of(found))
    typed = [_Level(lv.name, {path: kinds[f"{lv.name}:{path}"] for path in lv.leaves}, lv.step) for lv in words]
    text, start = F.col("_text"), plan.steps[0].path
    none = {
        "_values": F.lit(None).cast(f"struct<{', '.join(f'`{name}`: {kind}' for name, (kind, _) in found.items())}>"),
        "_words": F.lit(None).cast(f"struct<{', '.join(f'`{name}`: string' for name in found)}>"),
    }

    def rows(doc: Column, items: Column, chain: Sequence[_Level], filled: str) -> Column:
        def row(have: dict[str, Column]) -> Column:
            made = F.struct(*[have[place].alias(name) for name, (_, place) in found.items()])
            return F.struct(*[value.alias(name) for name, value in {**none, filled: made}.items()])

        flag = lambda have: have[found[only][1]] if only and filled == "_values" else F.lit(True)
        return _rows_below(items, chain[1:], row, flag, {f"{ROOT}:{path}": inside(doc, path) for path in chain[0].leaves})

    def in_words(doc: Column) -> Column:
        gaps = doc[REPORT].isNotNull() & _has_gap(inside(doc, start), words[1:], plan.steps[0])
        return rows(doc, F.when(gaps, _one_by_one(text, words)).otherwise(inside(doc, start)), words, "_words")

    def read(doc: Column) -> Column:
        sound = doc[REPORT].isNull() & ~_is_endless(doc, typed)
        again = _bound(_reported(text, words), in_words)
        return F.when(sound, rows(doc, inside(doc, start), typed, "_values")).otherwise(again)

    have = types_of(payloads)
    whole = lambda kind, place: ref(place[1:]) if have.get(place[1:]) == kind else read_place(place, list(have))
    raw = payloads.select(*[whole(*column).alias(name) for name, column in asked.items()], ref(body).alias("_text"))
    raw = raw.select(*refs(asked), F.inline(_bound(_reported(text, typed), read)))
    return raw.where(F.coalesce(field_at("_values", only), to_type(field_at("_words", only), "boolean"))) if only else raw


def _asked(plan: Plan) -> dict[str, tuple[str, ...]]:
    """Columns that come from the request."""
    return {name: column for name, column in plan.columns.items() if column[1].startswith("@")}


def _judged_plain(raw: DataFrame, plan: Plan, name: str, judge) -> DataFrame:
    """Like ``_judged``; only words come through the generator, as nothing can be wrong with values of their types."""
    have = types_of(raw)
    asked = {n: ref(n) for n in _asked(plan)}
    words = {n: asked[n] if n in asked else field_at("_words", n) for n in plan.columns}
    cast = {n: words[n] if have.get(n) == kind else to_type(words[n], kind) for n, (kind, *_) in plan.columns.items()}
    values = {n: cast[n] if n in asked else F.coalesce(field_at("_values", n), field_at("_typed", n)) for n in plan.columns}
    struct = lambda row: F.struct(*[value.alias(n) for n, value in row.items()])
    both = lambda t: F.struct(t.alias("_typed"), judge(_faults(plan, t, words)).alias("_judgement"))
    read = F.transform(F.array(F.lit(0)), lambda _: F.when(F.col("_words").isNotNull(), _bound(struct(cast), both)))
    judgement = F.when(F.col("_words").isNull(), judge(_faults(plan, values, asked))).otherwise(F.col("_judgement"))
    return raw.select("*", F.inline(read)).select(struct(values).alias("_typed"), judgement.alias(name))


def _judged(raw: DataFrame, plan: Plan, name: str, judge) -> DataFrame:
    """Typed values, each cast once, and beside them what ``judge`` makes of the faults; the texts end here."""
    texts = {name: ref(name) for name in plan.columns}
    made = F.struct(*[to_type(ref(name), kind).alias(name) for name, (kind, *_) in plan.columns.items()])
    typed = F.transform(F.array(F.lit(0)), lambda _: made)
    both = F.transform(typed, lambda t: F.struct(t.alias("_typed"), judge(_faults(plan, t, texts)).alias(name)))
    return raw.select(F.inline(both))


def _faults(plan: Plan, typed: Column | dict[str, Column], texts: dict[str, Column]) -> list[tuple[Column, str]]:
    """What can be wrong with a row, as conditions and messages; ``texts`` has what was cast."""
    missing = [(texts.get(name, typed[name]).isNull(), f"{name} is missing") for name in plan.required]
    unreadable = [
        (texts[name].isNotNull() & typed[name].isNull(), f"{name} is unreadable")
        for name, (kind, *_) in plan.columns.items()
        if kind != "string" and name in texts
    ]
    return missing + unreadable


def _typed_columns(plan: Plan) -> list[Column]:
    return [field_at("_typed", name).alias(name) for name in plan.columns]


def flagged(payloads: DataFrame, plan: Plan, body: str = "body", only: Column | None = None) -> DataFrame:
    """Typed rows of all payloads with ``_problems``: what they lack or cannot be read of, mostly nothing.

    One pass; good and bad rows are filters on it. ``only`` selects rows by their texts.
    """
    messages = lambda faults: F.array_compact(F.array(*_messages(faults))) if faults else F.array().cast("array<string>")
    rows = _judged(_raw(payloads, plan, body, only), plan, PROBLEMS, messages)
    return rows.select(*_typed_columns(plan), PROBLEMS)


def _messages(faults: list[tuple[Column, str]]) -> list[Column]:
    return [F.when(fault, F.lit(message)) for fault, message in faults]


def rejected(payloads: DataFrame, plan: Plan, body: str = "body", only: Column | None = None) -> DataFrame:
    """Rows that lack a required value or hold an unreadable one, and why."""
    return flagged(payloads, plan, body, only).where(F.size(PROBLEMS) > 0)


def flatten(
    payloads: DataFrame, plan: Plan, body: str = "body", fail: bool = True, only: Column | str | None = None, plain: bool = False
) -> DataFrame:
    """Typed rows of all payloads; ``only`` selects rows by their texts.

    A row that lacks a required value or holds an unreadable one fails the job.
    With ``fail`` off such rows are left out, and :func:`rejected` has them.
    ``plain`` gives the same rows, sooner where most payloads hold numbers and flags as such and not as
    texts. Such a plan walks lists alone, has one place for every column, and no defaults; ``only`` is
    the name of a flag.
    """
    first = lambda faults: F.coalesce(*_messages(faults), F.lit(None).cast("string"))
    raw, judged = (_raw_plain, _judged_plain) if plain else (_raw, _judged)
    rows = judged(raw(payloads, plan, body, only), plan, "_fault", first)
    fine = F.col("_fault").isNull()
    if fail:
        text = F.concat(F.lit("Payload row rejected: "), F.col("_fault"))
        fine = F.when(fine, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    return rows.where(fine).select(*_typed_columns(plan))


def long_form(payloads: DataFrame, plan: Plan, groups: dict[str, str], body: str = "body") -> DataFrame:
    """One row per (object, group, key, value) for objects with free keys.

    ``groups`` maps a group label to the place of its object. Nested objects are
    left out; lists and scalars are kept as text.
    """
    wanted = places_of(plan.columns)
    for place in groups.values():
        level, _, path = place.partition(":")
        wanted.setdefault(level, {})[path] = OBJECT
    rows = walk(payloads, plan.steps, wanted, body)
    fixed = [
        to_type(text, plan.columns[name][0]).alias(name) for name, text in _texts(plan, payloads.columns).items()
    ]
    scalars = lambda place: F.map_filter(ref(place), lambda k, v: F.coalesce(~is_object(v), F.lit(True)))
    maps = [F.struct(F.lit(g).alias("stat_group"), scalars(place).alias("stats")) for g, place in groups.items()]
    grouped = rows.select(*fixed, F.inline(F.array(*maps)))
    return grouped.select(*refs(plan.columns), "stat_group", F.explode("stats").alias("stat_key", "stat_value"))


def wide_form(
    payloads: DataFrame, plan: Plan, groups: dict[str, str], stats: dict[str, str], body: str = "body", fail: bool = True
) -> DataFrame:
    """The fixed columns plus declared stats, named ``group_key`` or ``key``."""
    columns = dict(plan.columns)
    for name, kind in stats.items():
        if name in columns:
            continue
        label, _, key = name.partition("_")
        prefixed = label in groups and bool(key)
        place = groups[label] if prefixed else groups.get("", next(iter(groups.values())))
        columns[name] = (kind, f"{place}.{key if prefixed else name}")
    return flatten(payloads, Plan(plan.steps, columns, plan.required, plan.defaults), body, fail)
