"""Compiling corrections into a node table: the base, proposals and their merge, generated nodes, dispositions, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean

#: From the one that decides first to the last; "applied" comes after "qualified".
FLAGS = ("qualified", "applied", "deferred", "enriched", "verified")


def base_table(nodes: DataFrame, fixes: DataFrame, protected: Sequence[str] = (), verbatim: Sequence[str] = ()) -> DataFrame:
    """Every node with its value as later stages see it: fixed, cleaned, stripped, and null where nothing is said.

    ``fixes`` (field_type, value, fixed) has at most one row a key. Fields that are protected stay as recorded;
    verbatim ones keep their outer separators.
    """
    found = nodes.join(fixes, ["field_type", "value"], "left")
    field = F.col("field_type")
    # A lambda's variable is worked out once; the same column written out several times may be worked out as often.
    once = lambda c, use: F.get(F.transform(F.array(c), use), F.lit(0))
    said = lambda text, bare: F.when(~(clean.is_empty(bare) | clean.says_nothing(text) | clean.says_nothing(bare) | clean.echoes(bare, field)), bare)
    own = once(clean.plain(F.coalesce("fixed", "value")), lambda text: once(F.when(field.isin(*verbatim), text).otherwise(clean.strip_separators(text)), lambda bare: said(text, bare)))
    value = F.when(field.isin(*protected), F.col("value")).otherwise(own)
    return found.withColumn("base_value", value).drop("fixed")


def merge(base: DataFrame, proposals: DataFrame, protected: Sequence[str]) -> DataFrame:
    """node_id, component, new_value, outcome of every proposal that would change its node.

    Of a node's valid proposals the one of the lowest tier is applied, then of the highest confidence, then by
    component and value; proposals of an unknown node, and those that change nothing, are no outcome.
    """
    own = proposals.join(base.select("node_id", "base_value", "field_type"), "node_id")
    own = own.withColumn(
        "outcome",
        F.when(F.col("field_type").isin(*protected), "protected_field")
        .when(F.col("expect_value") != F.coalesce("base_value", F.lit("")), "stale_snapshot")
        .when(~F.col("new_value").eqNullSafe(F.col("base_value")), "valid"),
    ).where("outcome IS NOT NULL")
    order = Window.partitionBy("node_id", "outcome").orderBy("tier", F.desc_nulls_last("confidence"), "component", "new_value")
    valid = F.when(F.row_number().over(order) == 1, "applied").otherwise("lost_precedence")
    return own.withColumn("outcome", F.when(F.col("outcome") == "valid", valid).otherwise(F.col("outcome"))).select("node_id", "component", "new_value", "outcome")


def dispositions(base: DataFrame, merged: DataFrame, flags: DataFrame) -> DataFrame:
    """``base`` with value, component and disposition: what was applied to a node, or else its strongest flag."""
    rank = F.create_map(*[F.lit(x) for i, f in enumerate(FLAGS) for x in (f, i)])
    strongest = flags.groupBy("node_id").agg(F.min_by("flag", rank[F.col("flag")]).alias("flag"))
    applied = merged.where("outcome = 'applied'").select("node_id", "component", F.col("new_value").alias("applied_value"))
    both = base.join(applied, "node_id", "left").join(strongest, "node_id", "left")
    decided = F.when(F.col("flag") == "qualified", F.col("flag")).when(F.col("component").isNotNull(), "applied").otherwise(F.coalesce("flag", F.lit("untouched")))
    value = F.when(F.col("component").isNotNull(), F.col("applied_value")).otherwise(F.col("base_value"))
    return both.withColumn("disposition", decided).withColumn("compiled_value", value).drop("flag", "applied_value")


def census(compiled: DataFrame) -> DataFrame:
    return compiled.groupBy("data_source", "field_type", "component", "disposition").agg(F.count("*").alias("n"))


def post_conditions(base: DataFrame, compiled: DataFrame, protected: Sequence[str]) -> DataFrame:
    """One row of counts, all 0 in a sound compile: nodes lost, invented or repeated, protected values changed, no disposition."""
    old = base.groupBy("node_id").agg(F.count("*").alias("before"), F.first("field_type").alias("field"), F.min("value").alias("recorded"))
    new = compiled.groupBy("node_id").agg(F.count("*").alias("after"), F.min("compiled_value").alias("written"), F.count("disposition").alias("decided"))
    both = old.join(new, "node_id", "full")
    many = lambda test: F.count_if(test)
    return both.agg(
        many(F.col("after").isNull()).alias("lost"), many(F.col("before").isNull()).alias("invented"), many(F.col("after") > F.col("before")).alias("repeated"),
        many(F.col("field").isin(*protected) & ~F.col("written").eqNullSafe(F.col("recorded"))).alias("protected_changed"), many(F.col("decided") < F.col("after")).alias("undecided"),
    )


def inline_groups(notes: DataFrame, group: str, parts: Mapping[str, Column], depth: int = 1) -> DataFrame:
    """A group node below each node that has any of ``parts``, and a child for each part it has.

    Ids are made from the parent's id and the field, so that a repeated run makes the same ones.
    """
    own_id = lambda *p: F.sha2(F.concat_ws("/", F.col("node_id").cast("string"), F.lit(group), *[F.lit(x) for x in p]), 256)
    node = lambda i, parent, d, field, value: F.struct(i.alias("node_id"), parent.alias("parent_id"), F.lit(d).alias("depth"), F.lit(field).alias("field_type"), value.alias("value"))
    children = [node(own_id(f), own_id(), depth + 1, f, v.cast("string")) for f, v in parts.items()]
    made = F.filter(F.array(*children), lambda c: c["value"].isNotNull())
    head = node(own_id(), F.col("node_id").cast("string"), depth, group, F.lit(None).cast("string"))
    return notes.select("record_id", made.alias("made"), head.alias("head")).where(F.size("made") > 0).select("record_id", F.inline(F.concat(F.array("head"), "made")))


def transfer(nodes: DataFrame, target: str, candidates: Sequence[str]) -> DataFrame:
    """record_id, value for records without the target field whose candidate fields hold exactly one distinct value."""
    found = F.when(F.col("field_type").isin(*candidates), F.col("value"))
    own = nodes.groupBy("record_id").agg(F.count_if((F.col("field_type") == target) & F.col("value").isNotNull()).alias("has"), F.min(found).alias("value"), F.max(found).alias("other"))
    return own.where("has = 0 AND value = other").select("record_id", "value")


def unanimous(children: DataFrame, key: str, value: str) -> DataFrame:
    """The value that all children of a parent have, nulls aside."""
    return children.groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("other")).where(F.col(value) == F.col("other")).drop("other")


def repeated_statements(tree: DataFrame) -> DataFrame:
    """Of each record: statements, and those that another with the same parent, field and value repeats."""
    same = tree.where("value IS NOT NULL").groupBy("record_id", "parent_id", "field_type", "value").agg(F.count("*").alias("n"))
    return same.groupBy("record_id").agg(F.sum("n").alias("statements"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated"))


def reused_titles(nodes: DataFrame, field: str, most: int = 25) -> DataFrame:
    """record_id, data_source, reuse, passes: whether the record's title isn't used as often as ``most`` in its source."""
    titles = nodes.where((F.col("field_type") == field) & F.col("value").isNotNull())
    uses = titles.groupBy("data_source", "value").agg(F.count("*").alias("reuse"))
    return titles.join(uses, ["data_source", "value"]).select("record_id", "data_source", "reuse", (F.col("reuse") < most).alias("passes"))


def failures(checked: DataFrame, checks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """check, applicable, failed over all rows; ``checks`` gives (applicable, passes) by name."""
    sums = [F.struct(F.lit(k).alias("check"), F.count_if(a).alias("applicable"), F.count_if(a & ~F.coalesce(p, F.lit(False))).alias("failed")) for k, (a, p) in checks.items()]
    return checked.agg(F.array(*sums).alias("all")).select(F.inline("all"))
