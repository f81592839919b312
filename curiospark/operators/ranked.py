"""Order statistics, winners and closures that never sort a whole group in one task.

Ranks are told from histograms (one row for each distinct measure of a group), and winners by aggregates, which
combine before the shuffle; so a group that holds most rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _before(keys: Sequence[str], order: Column) -> Window:
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def head_size(counts: DataFrame, keys: Sequence[str], count: str, tenths: int = 8, name: str = "k_80") -> DataFrame:
    """How many of a group's counts, largest first, are needed to reach a share of its sum."""
    blocks = counts.groupBy(*keys, count).agg(F.count("*").alias("m"))
    blocks = blocks.withColumn("total", F.sum(F.col(count) * F.col("m")).over(Window.partitionBy(*keys)))
    blocks = blocks.withColumn("before", F.coalesce(F.sum(F.col(count) * F.col("m")).over(_before(keys, F.desc(count))), F.lit(0)))
    below = F.expr(f"least(greatest(({tenths} * total - 10 * before - 1) div (10 * `{count}`), 0L), m)")
    return blocks.groupBy(*keys).agg(F.least(F.sum(below) + 1, F.sum("m")).alias(name))


def nearest_quantile(rows: DataFrame, keys: Sequence[str], measure: str, tenths: int, name: str) -> DataFrame:
    """The value at the index nearest to the quantile, of each group."""
    blocks = rows.where(F.col(measure).isNotNull()).groupBy(*keys, measure).agg(F.count("*").alias("m"))
    blocks = blocks.withColumn("n", F.sum("m").over(Window.partitionBy(*keys)))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("m").over(_before(keys, F.asc(measure))), F.lit(0)))
    at = F.expr(f"({tenths} * (n - 1) + 5) div 10")
    return blocks.where((F.col("before") <= at) & (at < F.col("before") + F.col("m"))).select(*keys, F.col(measure).alias(name))


def winners(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """The row of each key that comes first in ``order``, which must be total: nulls first, so negate for descending."""
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("w")).select(*keys, "w.*")


def hops(edges: DataFrame, child: str, parent: str, depth: int) -> DataFrame:
    """All ancestors within ``depth`` steps, each with its fewest steps."""
    found = reached = _steps(edges, child, parent)
    up = _up(found)
    for n in range(2, depth + 1):
        reached = _next(reached, up, n)
        found = found.unionByName(reached)
    return found.groupBy("subject", "ancestor").agg(F.min("steps").alias("steps"))


def closure(edges: DataFrame, child: str, parent: str, depth: int = 25) -> DataFrame:
    """All ancestors, each with its fewest steps; an error where ``depth`` steps leave some unreached, as in no hierarchy.

    Each round goes on only from pairs that are new, so cycles end, too.
    """
    found = reached = _steps(edges, child, parent).persist()
    up = _up(found)
    for n in range(2, depth + 2):
        reached = _next(reached, up, n).join(found, ["subject", "ancestor"], "left_anti").persist()
        if not reached.limit(1).count():
            return found
        found = found.unionByName(reached)
    raise ValueError(f"ancestors more than {depth} steps away")


def _steps(edges: DataFrame, child: str, parent: str) -> DataFrame:
    return edges.select(F.col(child).alias("subject"), F.col(parent).alias("ancestor")).distinct().withColumn("steps", F.lit(1))


def _up(steps: DataFrame) -> DataFrame:
    return steps.select(F.col("subject").alias("ancestor"), F.col("ancestor").alias("next"))


def _next(reached: DataFrame, up: DataFrame, n: int) -> DataFrame:
    return reached.join(up, "ancestor").select("subject", F.col("next").alias("ancestor"), F.lit(n).alias("steps")).distinct()


def islands(rows: DataFrame, keys: Sequence[str], at: str, gap: int) -> DataFrame:
    """Runs of values no more than ``gap`` apart: first and last value, number of rows."""
    points = rows.groupBy(*keys, at).agg(F.count("*").alias("n"))
    order = Window.partitionBy(*keys).orderBy(at)
    points = points.withColumn("new", F.coalesce((F.col(at) - F.lag(at).over(order) > gap).cast("int"), F.lit(0)))
    points = points.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return points.groupBy(*keys, "island").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.sum("n").alias("n"))


def false_discovery(tests: DataFrame, family: Sequence[str], p: str) -> DataFrame:
    """Benjamini-Hochberg q of each test within its family."""
    blocks = tests.groupBy(*family, p).agg(F.count("*").alias("same"))
    rank = F.sum("same").over(Window.partitionBy(*family).orderBy(p).rowsBetween(Window.unboundedPreceding, 0))
    blocks = blocks.withColumn("raw", F.col(p) * F.sum("same").over(Window.partitionBy(*family)) / rank)
    larger = Window.partitionBy(*family).orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0)
    q = blocks.select(*family, p, F.least(F.min("raw").over(larger), F.lit(1.0)).alias("q"))
    return tests.join(q, [*family, p])


def wilson_low(hits: Column, n: Column, z: float = 1.96) -> Column:
    share = hits / n
    return (share + z * z / (2 * n) - z * F.sqrt((share * (1 - share) + z * z / (4 * n)) / n)) / (1 + z * z / n)


def threshold_sweep(scored: DataFrame, keys: Sequence[str], score: str, hit: str) -> DataFrame:
    """At each distinct score: how many rows reach it, how many of them hit, the precision and its lower bound."""
    blocks = scored.groupBy(*keys, score).agg(F.count("*").alias("m"), F.sum(F.col(hit).cast("long")).alias("h"))
    down = Window.partitionBy(*keys).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    swept = blocks.select(*keys, score, F.sum("m").over(down).alias("n"), F.sum("h").over(down).alias("hits"))
    return swept.withColumn("precision", F.col("hits") / F.col("n")).withColumn("low", wilson_low(F.col("hits"), F.col("n")))
