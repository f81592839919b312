"""Statistics of measures and cells: spread, histograms, tests of difference, rank correlation, agreement, change points.

Distributions are reduced to one row a distinct value before anything is ordered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .ranked import nearest_quantile


def histogram(rows: DataFrame, measure: str, lo: float, hi: float, bins: int) -> DataFrame:
    """bin (from 0), n over [lo, hi]; the upper end belongs to the last bin."""
    at = F.least(F.floor((F.col(measure) - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    return rows.where(F.col(measure).between(lo, hi)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def spread(rows: DataFrame, keys: Sequence[str], measure: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Quartile range, standard deviation, share of the fullest bin and entropy of the bins (of 1) for each key."""
    at = F.least(F.greatest(F.floor((F.col(measure) - lo) * bins / (hi - lo)), F.lit(0)), F.lit(bins - 1))
    cells = rows.where(F.col(measure).isNotNull()).groupBy(*keys, at.alias("bin")).agg(F.count("*").alias("m"), F.sum(measure).alias("s"), F.sum(F.col(measure) * F.col(measure)).alias("ss"))
    n = F.sum("m")
    of_bins = cells.groupBy(*keys).agg(
        n.alias("n"), F.sqrt(F.greatest(F.sum("ss") / n - F.pow(F.sum("s") / n, F.lit(2)), F.lit(0.0))).alias("sd"), (F.max("m") / n).alias("modal_share"),
        ((F.ln(n) - F.sum(F.col("m") * F.ln("m")) / n) / math.log(bins)).alias("entropy"),
    )
    quartiles = [nearest_quantile(rows.withColumn("x4", F.col(measure)), keys, "x4", t, f"q{t}") for t in (2, 8)]
    return of_bins.join(quartiles[0], list(keys)).join(quartiles[1], list(keys)).withColumn("inner_range", F.col("q8") - F.col("q2")).drop("q2", "q8")


def chi_square(rows: DataFrame, keys: Sequence[str], side: str, category: str) -> DataFrame:
    """chi2, dof and Cramer's V of side against category within each key."""
    cells = rows.where(F.col(side).isNotNull() & F.col(category).isNotNull()).groupBy(*keys, side, category).agg(F.count("*").alias("o"))
    over = lambda *c: Window.partitionBy(*keys, *c)
    sums = cells.withColumn("r", F.sum("o").over(over(side))).withColumn("c", F.sum("o").over(over(category)))
    # The sum of (o - e)^2 / e over all cells, absent ones too, is n (sum of o^2 / (r c) - 1).
    got = sums.groupBy(*keys).agg(F.sum("o").alias("n"), F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("f"), F.countDistinct(side).alias("rs"), F.countDistinct(category).alias("cs"))
    least = F.least("rs", "cs") - 1
    return got.select(*keys, "n", (F.col("n") * (F.col("f") - 1)).alias("chi2"), ((F.col("rs") - 1) * (F.col("cs") - 1)).alias("dof"), F.when(least > 0, F.sqrt(F.greatest(F.col("f") - 1, F.lit(0.0)) / least)).alias("cramers_v"))


def kolmogorov_smirnov(rows: DataFrame, keys: Sequence[str], second: str, measure: str) -> DataFrame:
    """n1, n2, the largest distance of two distributions, and its asymptotic p; ``second`` is a boolean column."""
    n2 = F.count_if(F.col(second))
    points = rows.where(F.col(measure).isNotNull()).groupBy(*keys, measure).agg((F.count("*") - n2).alias("a"), n2.alias("b"))
    run = Window.partitionBy(*keys).orderBy(measure).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    points = points.select(*keys, F.sum("a").over(run).alias("ca"), F.sum("b").over(run).alias("cb"), F.sum("a").over(whole).alias("n1"), F.sum("b").over(whole).alias("n2")).where("n1 > 0 AND n2 > 0")
    d = points.groupBy(*keys, "n1", "n2").agg(F.max(F.abs(F.col("ca") / F.col("n1") - F.col("cb") / F.col("n2"))).alias("d"))
    scaled = F.pow(F.col("d"), F.lit(2)) * F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2"))
    series = sum((2 * (-1) ** (j - 1)) * F.exp(-2 * j * j * scaled) for j in range(1, 101))
    return d.withColumn("p", F.when(scaled < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))))


def spearman(rows: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Rank correlation of two measures within each key, with average ranks for ties."""
    both = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())

    def ranks(c: str, name: str) -> DataFrame:
        tied = both.groupBy(*keys, c).agg(F.count("*").alias("m"))
        before = F.coalesce(F.sum("m").over(Window.partitionBy(*keys).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return tied.select(*keys, c, (before + (F.col("m") + 1) / 2).alias(name))

    ranked = both.join(ranks(x, "rx"), [*keys, x]).join(ranks(y, "ry"), [*keys, y])
    return ranked.groupBy(*keys).agg(F.count("*").alias("n"), F.corr("rx", "ry").alias("rho"))


def agreement(first: DataFrame, second: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Found against gold rows (equal on keys and by): precision, recall and F1 for each value of ``by``."""
    a = first.select(*by, *keys).distinct().withColumn("found", F.lit(1))
    b = second.select(*by, *keys).distinct().withColumn("gold", F.lit(1))
    sums = a.join(b, [*by, *keys], "full").groupBy(*by).agg(F.count("found").alias("found"), F.count("gold").alias("gold"), F.count_if(F.col("found").isNotNull() & F.col("gold").isNotNull()).alias("hits"))
    ratio = lambda n, d: F.when(d > 0, n / d)
    return sums.select("*", ratio(F.col("hits"), F.col("found")).alias("precision"), ratio(F.col("hits"), F.col("gold")).alias("recall"), ratio(2 * F.col("hits"), F.col("found") + F.col("gold")).alias("f1"))


def paired_change(before: DataFrame, after: DataFrame, key: str, by: str, measure: str) -> DataFrame:
    """Means of a measure before and after where both have it, and how many rows gained or lost it."""
    both = before.select(key, by, F.col(measure).alias("x")).join(after.select(key, by, F.col(measure).alias("y")), [key, by])
    has = F.col("x").isNotNull() & F.col("y").isNotNull()
    return both.groupBy(by).agg(
        F.count_if(has).alias("paired"), F.avg(F.when(has, F.col("x"))).alias("mean_before"), F.avg(F.when(has, F.col("y"))).alias("mean_after"),
        F.count_if(F.col("x").isNull() & F.col("y").isNotNull()).alias("gained"), F.count_if(F.col("x").isNotNull() & F.col("y").isNull()).alias("lost"),
    )


def association(nodes: DataFrame) -> DataFrame:
    """phi of each pair of fields over the records: pairs are met by record, whose fields are few."""
    held = nodes.where("value IS NOT NULL").select("record_id", "field_type").distinct()
    total = nodes.agg(F.countDistinct("record_id").alias("n"))
    ones = held.groupBy("field_type").agg(F.count("*").alias("c"))
    other = held.withColumnRenamed("field_type", "other")
    pairs = held.join(other, "record_id").where("field_type < other").groupBy("field_type", "other").agg(F.count("*").alias("ab"))
    both = pairs.join(ones.withColumnRenamed("c", "a"), "field_type").join(ones.select(F.col("field_type").alias("other"), F.col("c").alias("b")), "other").join(F.broadcast(total))
    a, b, n = (F.col(c).cast("double") for c in "abn")
    below = F.sqrt(a * b * (n - a) * (n - b))
    return both.select("field_type", "other", F.when(below > 0, (n * F.col("ab") - a * b) / below).alias("phi"))


@F.pandas_udf(DoubleType())
def binomial_tail(hits: pd.Series, n: pd.Series, share: pd.Series) -> pd.Series:
    """P(at least ``hits`` of ``n``) where each hits with probability ``share``."""
    found = []
    for k, m, p in zip(hits, n, share):
        if k <= 0:
            found.append(1.0)
        elif p <= 0 or k > m:
            found.append(0.0)
        elif p >= 1:
            found.append(1.0)
        else:
            # The tail that the mean isn't in: its terms fall from its inner end on, by known ratios.
            upper = k > m * p
            at = k if upper else k - 1
            log = math.lgamma(m + 1) - math.lgamma(at + 1) - math.lgamma(m - at + 1) + at * math.log(p) + (m - at) * math.log1p(-p)
            total, term = 0.0, 1.0
            while 0 <= at <= m and term > total * 1e-17:
                total += term
                term *= (m - at) / (at + 1) * p / (1 - p) if upper else at / (m - at + 1) * (1 - p) / p
                at += 1 if upper else -1
            tail = math.exp(log) * total
            found.append(min(1.0, tail if upper else 1 - tail))
    return pd.Series(found, dtype="float64")


def _split(year: np.ndarray, hit: np.ndarray, n: np.ndarray, effect: float, z: float, side: int) -> tuple[int, float, float] | None:
    """The cut of the largest z among those with enough rows on both sides, effect and z."""
    left_n, left_h = np.cumsum(n)[:-1], np.cumsum(hit)[:-1]
    right_n, right_h = n.sum() - left_n, hit.sum() - left_h
    good = (left_n >= side) & (right_n >= side)
    if not good.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        change = right_h / right_n - left_h / left_n
        pooled = hit.sum() / n.sum()
        score = np.abs(change) / np.sqrt(pooled * (1 - pooled) * (1 / left_n + 1 / right_n))
    score = np.where(good & (np.abs(change) >= effect) & (score >= z), score, -1.0)
    best = int(np.argmax(score))
    return (best, float(change[best]), float(score[best])) if score[best] >= 0 else None


def coverage_steps(counts: DataFrame, keys: Sequence[str], effect: float = 0.3, z: float = 4.0, side: int = 150, depth: int = 6) -> DataFrame:
    """Years in which the share of records with a field changes, by binary segmentation of (keys, year, hits, n).

    A group is its years, so it is small whatever the number of records.
    """
    kinds = {f.name: f.dataType.simpleString() for f in counts.schema.fields}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", year int, change double, z double"
    yearly = counts.groupBy(*keys, "year").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))

    def steps(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("year")
        year, hit, n = rows["year"].to_numpy(), rows["hits"].to_numpy(float), rows["n"].to_numpy(float)

        def find(a: int, b: int, left: int) -> Iterator[tuple[int, float, float]]:
            got = _split(year[a:b], hit[a:b], n[a:b], effect, z, side) if left and b - a > 1 else None
            if got:
                cut = a + got[0] + 1
                yield from find(a, cut, left - 1)
                yield int(year[cut]), got[1], got[2]
                yield from find(cut, b, left - 1)

        found = [(*group, *x) for x in find(0, len(year), depth)]
        return pd.DataFrame(found, columns=[*keys, "year", "change", "z"])

    return yearly.groupBy(*keys).applyInPandas(steps, schema)


def mcnemar(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """Rows right only by one or only by the other, and the two-sided exact p that this is chance."""
    got = pairs.agg(F.count_if(F.col(first) & ~F.col(second)).alias("only_first"), F.count_if(~F.col(first) & F.col(second)).alias("only_second"))
    most, n = F.greatest("only_first", "only_second"), F.col("only_first") + F.col("only_second")
    return got.withColumn("p", F.least(F.lit(1.0), 2 * binomial_tail(most, n, F.lit(0.5))))


def hash_order(key: Column, seed: str) -> Column:
    """A fixed random order of keys."""
    return F.md5(F.concat_ws(":", F.lit(seed), key.cast("string")).cast("binary"))


def balanced_sample(rows: DataFrame, group: str, key: str, most: int, seed: str = "0") -> DataFrame:
    """At most ``most`` rows of each group, in a fixed random order of ``key``: sampling is the operator's purpose."""
    order = Window.partitionBy(group).orderBy(hash_order(F.col(key), seed), key)
    return rows.withColumn("ordinal", F.row_number().over(order)).where(F.col("ordinal") <= most)


def examples(rows: DataFrame, keys: Sequence[str], value: str, most: int = 3) -> DataFrame:
    """Count of each key's rows, and its ``most`` smallest distinct values."""
    cells = rows.groupBy(*keys, value).agg(F.count("*").alias("m"))
    order = Window.partitionBy(*keys).orderBy(value)
    first = cells.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias("examples"))
    return cells.groupBy(*keys).agg(F.sum("m").alias("n")).join(first, list(keys))
