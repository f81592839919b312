"""Rows dealt to as many tasks as their number needs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

#: A task takes about so many rows. Compact files come in few splits, however many rows these hold.
ROWS = 50_000


def dealt(df: DataFrame, key: str, rows: int = ROWS) -> DataFrame:
    """``df`` dealt by ``key`` to tasks of about ``rows`` rows, which are counted first; left as it is where one task is enough."""
    tasks = math.ceil(df.count() / rows)
    return df.repartition(tasks, key) if tasks > 1 else df
