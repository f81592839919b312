"""Object numbers that hold a year: which slots do, what they say, and whether recorded dates agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Of a year slot, of agreement with recorded dates, of structure where there are none.
FIRST_YEAR, LAST_YEAR, FOUR_DIGITS, IN_RANGE = 1750, 2026, 0.8, 0.9
TOLERANCE, LEAST_DATED, AGREES, DISAGREES, IMPOSSIBLE = 1, 30, 0.7, 0.3, 0.2
LEAST_YEARS, LEAST_SHARE = 5, 0.2
SLOT = "([0-9]+|[A-Za-z]+)"


def slots(value: Column) -> Column:
    """The runs of digits and of letters in a value, in order."""
    return F.regexp_extract_all(value, F.lit(SLOT), F.lit(1))


def year_at(value: Column, slot: Column) -> Column:
    """The four digits of a slot (from 0) as a year; null for another slot or none."""
    found = F.get(slots(value), slot)
    return F.when(found.rlike("^[0-9]{4}$"), found.try_cast("int"))


def year_slots(values: DataFrame, *by: str, least_four: float = FOUR_DIGITS, least_in_range: float = IN_RANGE) -> DataFrame:
    """The slots of each pattern (``by``) that read as years: mostly four digits, and those mostly between FIRST_YEAR and LAST_YEAR."""
    own = values.select(*by, F.posexplode(slots(F.col("value"))).alias("slot", "run"))
    year = F.when(F.col("run").rlike("^[0-9]{4}$"), F.col("run").try_cast("int"))
    counts = own.groupBy(*by, "slot").agg(F.count("*").alias("n"), F.count(year).alias("four"), F.count_if(year.between(FIRST_YEAR, LAST_YEAR)).alias("fit"))
    return counts.where((F.col("four") / F.col("n") >= least_four) & (F.col("four") > 0) & (F.col("fit") / F.nullif("four", F.lit(0)) >= least_in_range)).select(*by, "slot", "n", "four", "fit")


def encoded_years(values: DataFrame, found: DataFrame, *by: str) -> DataFrame:
    """Per record: its source, the earliest year that a year slot of its values holds, and its first value with one."""
    year = year_at(F.col("value"), F.col("slot"))
    rows = values.join(found.select(*by, "slot"), list(by)).withColumn("year", year).where(F.col("year").between(FIRST_YEAR, LAST_YEAR))
    return rows.groupBy("record_id").agg(F.min("data_source").alias("data_source"), F.min("year").alias("year"), F.min("value").alias("value"))


def field_years(nodes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per record: the earliest four-digit year in the first of ``fields`` that holds one, and that field."""
    rank = F.coalesce(*(F.when(F.col("field_type") == f, F.lit(k)) for k, f in enumerate(fields)))
    years = F.array_min(F.transform(F.regexp_extract_all("value", F.lit("([0-9]{4})"), F.lit(1)), lambda y: y.cast("int")))
    rows = nodes.where(F.col("field_type").isin(*fields)).select("record_id", "field_type", rank.alias("rank"), years.alias("year")).where("year is not null")
    best = rows.groupBy("record_id").agg(F.min(F.struct("rank", "year", "field_type")).alias("b"))
    return best.select("record_id", F.col("b.year").alias("year"), F.col("b.field_type").alias("year_source"))


def year_differences(encoded: DataFrame, recorded: DataFrame, made: DataFrame) -> DataFrame:
    """Encoded years less the recorded one, and less that of making, where there is one."""
    of = lambda df, name: df.select("record_id", F.col("year").alias(name))
    rows = encoded.join(of(recorded, "recorded"), "record_id", "left").join(of(made, "made"), "record_id", "left")
    return rows.select("record_id", "data_source", "year", "value", (F.col("year") - F.col("recorded")).alias("recorded_diff"), (F.col("year") - F.col("made")).alias("production_diff"))


def structure(encoded: DataFrame) -> DataFrame:
    """Per source: records, years, their span, and how often the highest number after the year falls from one year to the next."""
    tail = F.regexp_extract("value", r"(?:19|20)[0-9]{2}[^0-9]+([0-9]+)", 1).try_cast("long")
    years = encoded.groupBy("data_source", "year").agg(F.count("*").alias("n"), F.max(tail).alias("top"))
    whole = years.groupBy("data_source").agg(F.sum("n").alias("n_records"), F.count("*").alias("n_years"), (F.max("year") - F.min("year")).alias("year_span"))
    # A row for each year of a source: few, whatever the number of records.
    before = F.lag("top").over(Window.partitionBy("data_source").orderBy("year"))
    steps = years.where("top is not null").withColumn("before", before).where("before is not null")
    falls = steps.groupBy("data_source").agg(F.avg((F.col("top") < F.col("before")).cast("double")).alias("restart_rate"))
    return whole.join(falls, "data_source", "left").withColumn("restart_rate", F.coalesce("restart_rate", F.lit(0.0)))


def scheme_verdicts(differences: DataFrame, shape: DataFrame, coverage: DataFrame) -> DataFrame:
    """Per source of ``coverage`` (data_source, year_coverage): confirmed, plausible or rejected, and on what evidence.

    Dated records decide where there are LEAST_DATED; else the number of years and the share of numbers with one make a scheme plausible.
    """
    share = lambda cond: F.coalesce(F.avg(cond.cast("double")), F.lit(0.0))
    off = F.col("recorded_diff")
    found = differences.groupBy("data_source").agg(
        F.count("recorded_diff").alias("n_dated"), share(F.abs(off) <= TOLERANCE).alias("agree"), share(off < -TOLERANCE).alias("early"), share(off > TOLERANCE).alias("late"),
        F.count("production_diff").alias("n_production"), share(F.col("production_diff") < 0).alias("impossible"),
    )
    rows = coverage.join(found, "data_source", "left").join(shape.select("data_source", "n_years", "restart_rate"), "data_source", "left")
    dated = F.coalesce(F.col("n_dated"), F.lit(0)) >= LEAST_DATED
    good, bad = (F.col("agree") >= AGREES) & (F.col("impossible") <= IMPOSSIBLE), (F.col("agree") <= DISAGREES) | (F.col("impossible") > IMPOSSIBLE)
    built = (F.coalesce(F.col("n_years"), F.lit(0)) >= LEAST_YEARS) & (F.col("year_coverage") >= LEAST_SHARE)
    verdict = F.when(dated & good, "confirmed").when(dated & bad, "rejected").when(dated | built, "plausible").otherwise("rejected")
    return rows.withColumn("verdict", verdict).withColumn("evidence", F.when(dated, "dated records").otherwise("structure"))


def complete_year(digits: Column, ceiling: Column) -> Column:
    """Two digits as the latest such year up to the ceiling, null without one; other texts stay."""
    year = ceiling - F.pmod(ceiling - digits.try_cast("int"), F.lit(100))
    return F.when(~digits.rlike("^[0-9]{2}$"), digits).otherwise(F.lpad(year.cast("string"), 4, "0"))
