"""JSON of any depth: one written form, objects and leaves at all levels, values inside other text. One Arrow pass each, no depth limit of its own.

Text that is no JSON, or nested deeper than Python's reader goes (some thousand levels), gives null.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_COMPACT = {"ensure_ascii": False, "separators": (",", ":")}


class Number(str):
    """A number as it was written."""


def parsed(text: str | None, **how):
    """A value in a list, or None where the text is no JSON."""
    if text is None:
        return None
    try:
        return [json.loads(text, **how)]
    except (ValueError, RecursionError):
        return None


def inner(value) -> Iterator[tuple[str, object]]:
    return iter(value.items()) if isinstance(value, dict) else ((str(i), v) for i, v in enumerate(value))


def rounded(value, digits: int, drop: frozenset):
    """A copy with fractions rounded and keys left out, made level by level."""
    top: list = [value]
    todo: list = [(top, 0)]
    while todo:
        holder, key = todo.pop()
        v = holder[key]
        if isinstance(v, float):
            holder[key] = round(v, digits)
        elif isinstance(v, dict):
            holder[key] = new = {k: x for k, x in v.items() if k not in drop}
            todo += [(new, k) for k in new]
        elif isinstance(v, list):
            holder[key] = new = list(v)
            todo += [(new, i) for i in range(len(new))]
    return top[0]


def canonical(text: Column, digits: int | None = None, drop: tuple[str, ...] = ()) -> Column:
    """JSON with keys in order at all levels and no space; types stay, so 1, 1.0 and "1" differ. With `digits`, fractions are rounded; keys in `drop` go."""

    @F.pandas_udf(StringType())
    def written(texts: pd.Series) -> pd.Series:
        def one(x):
            found = parsed(x)
            if found is None:
                return None
            try:
                return json.dumps(rounded(found[0], 400 if digits is None else digits, frozenset(drop)), sort_keys=True, **_COMPACT)
            except RecursionError:
                return None

        return texts.map(one)

    return written(text)


def over_levels(text: Column, kind: str, what: Callable) -> Column:
    """An array of what a function yields for each (path, value) of a document, outer ones first."""

    @F.pandas_udf(f"array<{kind}>")
    def found(texts: pd.Series) -> pd.Series:
        def one(x):
            top = parsed(x, parse_int=Number, parse_float=Number)
            if top is None:
                return None
            out, level = [], [("", top[0])]
            while level:
                below = []
                for path, v in level:
                    out += what(path, v)
                    if isinstance(v, dict | list):
                        below += [(f"{path}/{k}", y) for k, y in inner(v)]
                level = below
            return out

        return texts.map(one)

    return found(text)


def number_texts(value):
    """A value whose numbers can be written again."""
    if isinstance(value, Number):
        return float(value) if set(value) & set(".eE") else int(value)
    if isinstance(value, dict):
        return {k: number_texts(v) for k, v in value.items()}
    return [number_texts(v) for v in value] if isinstance(value, list) else value


def objects(text: Column) -> Column:
    """All objects inside a document as JSON, itself too, those of outer levels first."""
    return over_levels(text, "string", lambda _, v: [json.dumps(number_texts(v), **_COMPACT)] if isinstance(v, dict) else [])


def leaf(path: str, v) -> list[dict]:
    if isinstance(v, dict | list) and v:
        return []
    value = None if v is None else str(v) if isinstance(v, str) else json.dumps(v)
    return [{"path": path, "value": value}]


def leaves(text: Column) -> Column:
    """Paths and scalar values of a document as texts; numbers as written, empty objects and arrays as {} and []."""
    return over_levels(text, "struct<path:string,value:string>", leaf)


def values_after(text: Column, mark: str) -> Column:
    """The JSON values that begin right after a mark, as they stand, however deep; a mark inside such a value counts for nothing, and one that no value follows is passed over."""

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        read = json.JSONDecoder().raw_decode

        def one(x):
            out, at = [], x.find(mark) if x is not None else -1
            while at >= 0:
                begin = at + len(mark)
                begin += len(x[begin : begin + 200]) - len(x[begin : begin + 200].lstrip())
                end = begin
                try:
                    end = read(x, begin)[1]
                    out.append(x[begin:end])
                except (ValueError, RecursionError):
                    pass
                at = x.find(mark, max(end, at + len(mark)))
            return out

        return texts.map(one)

    return found(text)
