"""Retrieval over records: bags of words by family of fields, bounds of years, and records ranked by the predicates they meet."""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import word_prefixes

MOST_YEAR, LEAST_TOKEN = 2100, 3


def folded(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(value), "[^0-9a-z]+", " "))


def query_tokens(term: str) -> list[str]:
    return [t for t in re.sub("[^0-9a-z]+", " ", term.lower()).split() if len(t) >= LEAST_TOKEN]


def text_index(nodes: DataFrame, families: Mapping[str, Sequence[str]], expansion: DataFrame | None = None, places: str = "place") -> DataFrame:
    """record_id, data_source, family, bag (its distinct folded values, in order); ``expansion`` (term, extra) adds words to terms of the family ``places``."""
    family = F.coalesce(*(F.when(F.col("field_type").isin(*fields), name) for name, fields in families.items()))
    rows = nodes.where("value is not null").select("record_id", "data_source", family.alias("family"), folded(F.col("value")).alias("term")).where("family is not null and term <> ''")
    if expansion is not None:
        extra = F.when(F.col("family") == places, F.col("extra"))
        rows = rows.join(expansion, "term", "left").withColumn("term", F.concat_ws(" ", "term", extra))
    return rows.groupBy("record_id", "data_source", "family").agg(F.array_join(F.array_sort(F.collect_set("term")), " ").alias("bag"))


def date_index(nodes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """record_id, year_lo, year_hi of the years that date fields name."""
    year = F.nullif(F.regexp_extract("value", "(-?[0-9]{3,4})", 1), F.lit("")).cast("int")
    rows = nodes.where(F.col("field_type").isin(*fields)).select("record_id", year.alias("y")).where(F.abs("y") <= MOST_YEAR)
    return rows.groupBy("record_id").agg(F.min("y").alias("year_lo"), F.max("y").alias("year_hi"))


def ranked(bags: DataFrame, dates: DataFrame, predicates: Sequence[tuple], k: int = 25) -> DataFrame:
    """The ``k`` records that meet most predicates, ties by id: (family, term) or ("date", lo, hi). One pass over each index."""
    hits = []
    for p in predicates:
        if p[0] == "date":
            _, lo, hi = p
            hits.append(dates.where((F.col("year_lo") <= hi) & (F.col("year_hi") >= lo)).select("record_id"))
            years = F.transform(F.regexp_extract_all("bag", F.lit("(-?[0-9]{3,4})")), lambda y: y.cast("int"))
            hits.append(bags.where((F.col("family") == "date") & F.exists(years, lambda y: y.between(lo, hi))).join(dates, "record_id", "left_anti").select("record_id").distinct())
        elif tokens := query_tokens(p[1]):
            hits.append(word_prefixes(bags.where(F.col("family") == p[0]), tokens).select("record_id"))
    found = functools.reduce(DataFrame.unionAll, hits).groupBy("record_id").agg(F.count("*").alias("n_matched"))
    sources = bags.groupBy("record_id").agg(F.min("data_source").alias("data_source"))
    return found.join(sources, "record_id").orderBy(F.desc("n_matched"), "record_id").limit(k)
