"""Cutting JSON values out of page source: a regex cannot count braces."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# How far a value may reach.
MOST_CHARS = 30_000
_STOP = re.compile(r'\\.|["{}]', re.DOTALL)


def balanced(text: str, start: int, most: int = MOST_CHARS) -> str | None:
    """The object whose brace is at start; braces in strings do not count, escapes are skipped."""
    depth, quoted = 0, False
    for m in _STOP.finditer(text, start, min(len(text), start + most)):
        mark = m[0]
        if mark == '"':
            quoted = not quoted
        elif mark == "{" and not quoted:
            depth += 1
        elif mark == "}" and not quoted:
            depth -= 1
            if not depth:
                return text[start : m.end()]
    return None


def value_at_key(text: str | None, key: str, most: int = MOST_CHARS) -> tuple[str | None, str | None]:
    """("null", None), ("object", its JSON or None if it is broken) or (None, None) for the first ``"key":``."""
    at = (text or "").find(f'"{key}"')
    if at < 0:
        return None, None
    at += len(key) + 2
    while at < len(text) and text[at] in " \t:":
        at += 1
    if text.startswith("null", at):
        return "null", None
    if not text.startswith("{", at):
        return None, None
    found = balanced(text, at, most)
    if found is None:
        return None, None
    try:
        json.loads(found)
    except ValueError:
        return "object", None
    return "object", found


def json_at_key(text: Column, key: str, most: int = MOST_CHARS) -> Column:
    """struct<kind, json> of the value at a key, an Arrow batch at a time."""

    @F.pandas_udf("kind string, json string")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([value_at_key(t, key, most) for t in texts], columns=["kind", "json"], dtype=object)

    return run(text)


def object_after(text: Column, needle: str, most: int) -> Column:
    """The JSON object at the first brace after needle; null if it is missing, unbalanced or broken."""

    def cut(t: str | None) -> str | None:
        at = (t or "").find(needle)
        brace = t.find("{", at) if at >= 0 else -1
        found = balanced(t, brace, most) if brace >= 0 else None
        try:
            return found if found is not None and json.loads(found) is not None else None
        except ValueError:
            return None

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([cut(t) for t in texts], dtype=object)

    return run(text)
