"""Tokens of short recorded values, and parsers of such values as columns, a batch of distinct values at a time."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

_TOKEN = re.compile(r"(?P<number>\d+(?:\.\d+)?)|(?P<word>[^\W\d_]+)|(?P<mark>\S)")


@dataclass(frozen=True)
class Token:
    kind: str
    text: str
    start: int
    end: int


def tokens(text: str) -> list[Token]:
    """Numbers, words and single marks; space only parts them."""
    return [Token(m.lastgroup, m[0], m.start(), m.end()) for m in _TOKEN.finditer(text)]


def column_parser(read: Callable[[str], object], ddl: str) -> Callable[[Column], Column]:
    """``read``, which gives a value of type ``ddl`` or None for a string, as a column function; null stays null.

    Arrow batches; a value that repeats in a batch is read once.
    """

    def wrapped(values: pd.Series) -> pd.Series:
        # A struct column of a pandas UDF can't hold null rows, a list can.
        known = {v: read(v) for v in values.dropna().unique()}
        return pd.Series([[x] if v is not None and (x := known[v]) is not None else None for v in values], index=values.index, dtype=object)

    return lambda raw: pandas_udf(wrapped, f"array<{ddl}>")(raw)[0]
