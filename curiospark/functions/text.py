"""Text normalisers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of at least two letters, marks, digits or connectors.
WORD = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]{2,}"


def norm_term(text: Column) -> Column:
    """The form vocabularies are keyed by: lower case, single spaces, no outer spaces or stops."""
    return F.btrim(F.regexp_replace(F.lower(text), r"\s+", " "), F.lit(" .,;:"))


def fold(text: Column) -> Column:
    """The form that retrieval compares: lower-case ASCII letters and digits, single spaces."""
    return F.btrim(F.regexp_replace(F.lower(text), "[^0-9a-z]+", " "))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def runs(text: Column) -> Column:
    """Letters become s and digits d; then the maximal runs of s, of d, and each other character."""
    masked = F.regexp_replace(F.regexp_replace(text, "[A-Za-z]", "s"), "[0-9]", "d")
    return F.regexp_extract_all(masked, F.lit(r"(d+|s+|[\s\S])"), F.lit(1))


def signature(text: Column) -> Column:
    """Runs with their lengths: d{4}-d{2} for 1954-03."""
    long = lambda r: r.rlike("^(ss+|dd+)$")
    return F.array_join(F.transform(runs(text), lambda r: F.when(long(r), F.concat(F.left(r, F.lit(1)), F.lit("{"), F.length(r), F.lit("}"))).otherwise(r)), "")


def skeleton(text: Column) -> Column:
    """Runs without their lengths."""
    return F.array_join(F.transform(runs(text), lambda r: F.left(r, F.lit(1))), "")
