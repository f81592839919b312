"""Record metrics over a node table, as DataFrame plans: completeness, information content, field profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["record_id", "data_source"]


def field_weights(nodes: DataFrame, core: Sequence[str], applicable: float = 0.1) -> DataFrame:
    """Weight of each field for each source: the larger of its mean fill over sources and its fill there.

    Both grids are small (sources by fields); only the distinct count of records meets the data.
    """
    records = nodes.select(*KEYS).distinct().groupBy("data_source").agg(F.count("*").alias("total"))
    described = nodes.where(F.col("value").isNotNull() & ~F.col("field_type").isin(*core))
    filled = described.groupBy("field_type", "data_source").agg(F.countDistinct("record_id").alias("n"))
    grid = records.crossJoin(described.select("field_type").distinct())
    local = grid.join(filled, ["field_type", "data_source"], "left").withColumn("local", F.coalesce("n", F.lit(0)) / F.col("total"))
    both = local.withColumn("overall", F.avg("local").over(Window.partitionBy("field_type")))
    return both.where((F.col("overall") > applicable) | (F.col("local") > applicable)).select("field_type", "data_source", F.greatest("overall", "local").alias("w"))


def completeness(nodes: DataFrame, core: Sequence[str], weights: DataFrame | None = None) -> DataFrame:
    """Share of its source's applicable weight that a record fills, of the records with all core fields."""
    weights = field_weights(nodes, core) if weights is None else weights
    total = weights.groupBy("data_source").agg(F.sum("w").alias("total"))
    present = nodes.where(F.col("value").isNotNull())
    eligible = present.where(F.col("field_type").isin(*core)).groupBy(*KEYS).agg(F.countDistinct("field_type").alias("n")).where(F.col("n") == len(core)).drop("n")
    filled = present.where(~F.col("field_type").isin(*core)).select(*KEYS, "field_type").distinct()
    got = filled.join(weights, ["field_type", "data_source"]).groupBy(*KEYS).agg(F.sum("w").alias("got"))
    joined = eligible.join(got, KEYS, "left").join(total, "data_source", "left")
    return joined.select(*KEYS, (F.coalesce("got", F.lit(0.0)) / F.col("total")).alias("completeness"))


def value_frequencies(nodes: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """How often each value occurs in its field, and how many values the field has."""
    counts = nodes.where(F.col("field_type").isin(*categorical) & F.col("value").isNotNull()).groupBy("field_type", "value").agg(F.count("*").alias("times"))
    return counts.withColumn("n_f", F.sum("times").over(Window.partitionBy("field_type")))


def information_content(frequencies: DataFrame) -> DataFrame:
    """0 for a value that all share, 1 for one that occurs once; a field with one value has none (null)."""
    ic = F.when(F.col("n_f") > 1, 1 - F.ln("times") / F.ln("n_f"))
    return frequencies.select("field_type", "value", F.least(F.greatest(ic, F.lit(0.0)), F.lit(1.0)).alias("ic"))


def conformance_to_expectations(nodes: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Each record's mean information content over its categorical values."""
    ic = information_content(value_frequencies(nodes, categorical))
    own = nodes.where(F.col("field_type").isin(*categorical) & F.col("value").isNotNull())
    return own.join(ic, ["field_type", "value"], "left").groupBy(*KEYS).agg(F.avg("ic").alias("information_content"), F.count("*").alias("n_values"))
