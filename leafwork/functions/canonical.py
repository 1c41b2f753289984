"""Strict canonical JSON: sorted keys, no spaces, no duplicate keys, no NaN. It decides identity, so it is Python's own."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _strict(pairs):
    found = dict(pairs)
    if len(found) != len(pairs):
        raise ValueError("a key occurs twice")
    return found


def _constant(name):
    raise ValueError(name)


def canonical_text(text: str | None) -> str | None:
    """The canonical form of a JSON object's text, or None if it isn't one."""
    try:
        value = json.loads(text, object_pairs_hook=_strict, parse_constant=_constant)
    except (TypeError, ValueError, RecursionError):
        return None
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) if isinstance(value, dict) else None


def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(canonical_text)


def canonical_json(c: Column | str) -> Column:
    return F.pandas_udf(_canonical, "string")(c)
