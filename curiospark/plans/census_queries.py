"""Queries of the matching, census, induction and retrieval operators and of the value parsers, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dimensions as D
from ..functions import parsers, persons
from ..functions.text import norm_term
from ..operators import census, induction, matching, retrieval
from ..sources import records
from ..sources.dealt import dealt
from ..sources.nodes import PART_NODES_SQL, part_nodes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    for n in names:
        df = df.withColumn(n, F.round(n, 9))
    return df


# Expressions that run in both dialects.
_NAME = "concat(p_name, ' ', CAST(p_partkey % 7 AS VARCHAR(9)))"
_MESSY = """CASE p_partkey % 6 WHEN 0 THEN concat('<b>', p_name, '</b>') WHEN 1 THEN concat(p_name, ' &amp; more of it') WHEN 2 THEN CAST(p_size AS VARCHAR(9)) WHEN 3 THEN p_name WHEN 4 THEN concat('https://example.org/', CAST(p_partkey AS VARCHAR(9))) ELSE concat(p_name, ' ', p_type, ' ', p_brand) END"""
_YEAR = "concat('made in ', CAST(1900 + p_partkey % 200 AS VARCHAR(9)))"
_COUNTED = "CASE WHEN p_partkey % 5 = 0 THEN concat(CAST(p_size AS VARCHAR(9)), '.5') WHEN p_partkey % 11 = 0 THEN 'many' ELSE CAST(p_size AS VARCHAR(9)) END"
_LISTED = "CASE p_partkey % 5 WHEN 0 THEN concat(p_name, ' / ', 'blue bolt') WHEN 1 THEN concat(p_name, ' and red widget') WHEN 2 THEN concat(p_name, ' & ', p_name, ' & hot gear') WHEN 3 THEN concat(p_name, ' (', p_type, ')') ELSE p_name END"
_CODE = "CASE p_partkey % 3 WHEN 0 THEN concat(substring(p_type, 1, 2), CAST(p_partkey AS VARCHAR(9)), '.', CAST(p_size AS VARCHAR(9))) WHEN 1 THEN concat(CAST(p_size AS VARCHAR(9)), '-', CAST(p_partkey % 90 AS VARCHAR(9))) ELSE CAST(p_partkey AS VARCHAR(9)) END"
_CONF_FIELDS = [("title", _NAME), ("descr", _MESSY), ("objnum", "CAST(p_partkey AS VARCHAR(9))"), ("made", _YEAR), ("count", _COUNTED), ("note", "CASE WHEN p_partkey % 4 = 0 THEN p_name END"), ("note", "CASE WHEN p_partkey % 8 = 0 THEN p_name END")]


def _catalogue(spark, sf_dir) -> DataFrame:
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field_type"), F.expr(e).alias("value")) for f, e in _CONF_FIELDS)))
    rows = dealt(_table(spark, sf_dir, "part"), "p_partkey").select(F.col("p_partkey").alias("record_id"), F.col("p_brand").alias("data_source"), pairs.alias("p"))
    return rows.select("record_id", "data_source", F.lit(0).alias("parent_id"), "p.field_type", "p.value")


_CATALOGUE_SQL = "cat AS (" + " UNION ALL ".join(f"SELECT p_partkey AS record_id, p_brand AS data_source, 0 AS parent_id, '{f}' AS field_type, {e} AS value FROM part" for f, e in _CONF_FIELDS) + ")"


def conformance(spark, sf_dir):
    found = census.conformance(_catalogue(spark, sf_dir), "title", "descr", "objnum", ("made",), ("descr", "note"), ("title", "descr", "objnum", "made", "count"), ("count",), ("objnum",))
    return _rounded(found, "conformance", "pass_model_typed")


def disguised_nulls(spark, sf_dir):
    found = census.null_markers(_catalogue(spark, sf_dir).where("field_type <> 'objnum'"), ("many",), 0.0005, 2, 2, 1)
    return _rounded(found, "share")


def interval_statuses(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem")
    hits = lines.where("l_linenumber > 1").select(F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").alias("node"), (F.col("l_partkey") % 40).alias("lo"), (F.col("l_partkey") % 40 + F.col("l_suppkey") % 9).alias("hi"))
    first = lines.where("l_linenumber = 1 AND l_returnflag <> 'N'").select(F.col("l_orderkey").alias("record_id"), (F.col("l_partkey") % 40).alias("slo"), (F.col("l_partkey") % 40 + F.col("l_suppkey") % 9).alias("shi"))
    fields = _table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("record_id"))
    return matching.interval_status(hits, first, fields, "record_id", ["node"])


def placed_in_context(spark, sf_dir):
    part = dealt(_table(spark, sf_dir, "part"), "p_partkey")
    index = part.select(F.split("p_name", " ")[0].alias("head"), F.col("p_partkey").alias("subject"), F.array(F.lower("p_type"), F.lower("p_brand")).alias("known"), (F.col("p_size") * F.when(F.col("p_partkey") % 100 == 0, 9000).otherwise(1)).cast("long").alias("prominence"))
    index = index.where("subject % 3 = 0 OR prominence > 40")
    context = F.when(F.col("p_partkey") % 4 == 0, F.array().cast("array<string>")).when(F.col("p_partkey") % 4 == 1, F.array(F.lower("p_type"), F.lower("p_brand"))).otherwise(F.array(F.lower("p_brand")))
    targets = part.select(F.col("p_partkey").alias("norm"), F.concat_ws(" ", F.split("p_name", " ")[0]).alias("head"), context.alias("context"))
    return matching.resolve_in_context(targets, index)


def ancestor_terms(spark, sf_dir):
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    index = nation.select(F.concat(F.lit("n"), "n_nationkey").alias("subject"), F.lower("n_name").alias("norm")).union(region.select(F.concat(F.lit("r"), "r_regionkey"), F.lower("r_name")))
    customers = _table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    ancestors = customers.select(F.col("c_custkey").alias("subject"), F.explode(F.array(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"))).alias("ancestor"))
    norms = region.select(F.lower("r_name").alias("norm")).union(nation.where("n_nationkey < 5").select(F.lower("n_name")))
    return matching.context_matches(index, ancestors, customers.where("c_acctbal > 0").select(F.col("c_custkey").alias("subject")), norms)


def sole_suppliers(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("subject"), F.col("o_orderkey").alias("via"))
    lines = _table(spark, sf_dir, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("via"), F.col("l_suppkey").alias("supplier"))
    return matching.bridge(orders, lines, "via", "subject", "supplier")


def _listed(spark, sf_dir) -> DataFrame:
    rows = _table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, "even").otherwise("odd").alias("group"), F.col("p_brand").alias("data_source"), F.expr(_LISTED).alias("value"))
    return rows.groupBy("group", "data_source", "value").agg(F.count("*").alias("count")).withColumn("norm", norm_term(F.col("value")))


_LIMITS = induction.Limits(literal=100, connective=50, fragments=2, support=5)


def separator_candidates(spark, sf_dir):
    return induction.separator_candidates(_listed(spark, sf_dir), _LIMITS)


def _attested(values: DataFrame) -> DataFrame:
    return values.groupBy("group", "norm").agg(F.sum("count").alias("n")).where("n >= 2").select("group", "norm")


def separator_scores(spark, sf_dir):
    values = _listed(spark, sf_dir)
    candidates = values.select("group").distinct().join(spark.createDataFrame([("even", "/"), ("odd", "/"), ("even", "and"), ("odd", "and"), ("even", "&"), ("odd", "&")], "group string, separator string"), "group")
    return _rounded(induction.score_separators(values, candidates, _attested(values), _LIMITS), "attestation")


def merged_patterns(spark, sf_dir):
    rows = _table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, "date").otherwise("code").alias("merge_group"), F.expr(_CODE).alias("value"))
    return induction.merged_patterns(rows, ("date",))


def field_coverage(spark, sf_dir):
    return _rounded(census.status_coverage(_annotations(spark, sf_dir))[0], "resolved", "flagged", "deferred")


def source_coverage(spark, sf_dir):
    return _rounded(census.status_coverage(_annotations(spark, sf_dir))[1], "resolved_occ", "resolved_distinct")


_STATUS = "CASE l_partkey % 9 WHEN 0 THEN 'rejected' WHEN 1 THEN 'flagged' WHEN 2 THEN 'deferred' ELSE 'resolved' END"


def _annotations(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("field_type"), (F.col("l_suppkey") % 10).alias("data_source"), F.col("l_linestatus").alias("group"), (F.col("l_partkey") % 900).alias("value"), F.expr(_STATUS.replace("l_partkey", "(l_partkey % 900)")).alias("status"))


def owning_stages(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 50).alias("field_type"), (F.col("l_suppkey") % 10).alias("data_source"), F.expr("CASE WHEN l_linenumber < 3 THEN concat('c', l_suppkey % 3) END").alias("component"), F.expr("CASE WHEN l_partkey % 50 < 10 OR l_quantity > 30 THEN 'untouched' WHEN l_quantity > 20 THEN 'verified' WHEN l_quantity > 10 THEN 'applied' ELSE 'qualified' END").alias("disposition"))
    counts = rows.groupBy("field_type", "data_source", "component", "disposition").agg(F.count("*").alias("occurrences"))
    return _rounded(census.owning_stages(counts), "worked_share", "owning_stage_share")


def marker_styles(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("source").alias("data_source"), "text")
    marks = {"question": F.col("text").contains("?"), "brackets": F.col("text").contains("["), "links": F.col("text").contains("http")}
    return _rounded(census.marker_rates(rows, marks, 0.02), *marks)


def year_cohorts(spark, sf_dir):
    return census.richness(*_dated(spark, sf_dir))[2]


def field_years(spark, sf_dir):
    return census.richness(*_dated(spark, sf_dir))[1]


def record_richness(spark, sf_dir):
    return census.richness(*_dated(spark, sf_dir))[0]


def _dated(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = _table(spark, sf_dir, "orders")
    nodes = orders.select(F.col("o_orderkey").alias("record_id"), F.col("o_orderpriority").alias("data_source"), F.explode(F.array(F.struct(F.lit("status").alias("field_type"), F.col("o_orderstatus").alias("value")), F.struct(F.lit("total").alias("field_type"), F.expr("CASE WHEN o_custkey % 3 > 0 THEN CAST(CAST(o_totalprice AS BIGINT) AS STRING) END").alias("value")))).alias("p")).select("record_id", "data_source", "p.*")
    return nodes, orders.select(F.col("o_orderkey").alias("record_id"), F.year("o_orderdate").alias("year"))


def extraction_queue(spark, sf_dir):
    return census.extraction_queue(_catalogue(spark, sf_dir), ("descr", "title"), {"note": ("note",), "made": ("made",), "size": ("size",)}, 20, 100)


def review_strata(spark, sf_dir):
    rows = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("stratum"), "p_size")
    return census.review_strata(rows, "stratum", "p_partkey", "p_size", 5)


def routed_values(spark, sf_dir):
    value = F.expr("CASE p_partkey % 6 WHEN 0 THEN 'n/a' WHEN 1 THEN concat(p_name, ' | ', p_type) WHEN 2 THEN 'Unknown' WHEN 3 THEN repeat(concat(p_name, ' '), 13) ELSE p_name END")
    rows = _table(spark, sf_dir, "part").select("p_partkey", value.alias("value"), F.col("p_brand").alias("source"))
    return rows.select("p_partkey", census.route(F.lower(F.trim("value")), F.col("value"), ("n/a",), ("unknown",), twice=F.col("source") == "Brand#11").alias("route"))


def relaxed_union(spark, sf_dir):
    suppliers = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("extra"))
    customers = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("extra"))
    return matching.union_relaxed(suppliers, customers)


def word_set_changes(spark, sf_dir):
    rows = _table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("a"), F.split(F.concat_ws(" ", F.element_at(F.split("p_name", " "), 1), F.lower("p_type")), " ").alias("b"))
    changes = matching.set_changes(F.col("a"), F.col("b"))
    return rows.select("p_partkey", *(F.array_join(changes[k], " ").alias(k) for k in ("gone", "new", "same", "all")))


def consensus_events(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").where("l_quantity > 49 AND l_linenumber = 1")
    steps = lines.select((F.col("l_suppkey") % 20).alias("data_source"), (1900 + (F.col("l_partkey") * 7) % 300).alias("year"), F.concat(F.lit("f"), F.col("l_orderkey")).alias("signal"), (F.col("l_discount") + F.lit(0.01)).alias("effect"), F.col("l_partkey").alias("n_before"), F.col("l_orderkey").alias("n_after"))
    return census.consensus(steps)


def licensed_nodes(spark, sf_dir):
    rows = part_nodes(spark, sf_dir).withColumn("value", F.when((F.col("field_type") == "p_type") & F.col("value").startswith("E"), "CC 0").otherwise(F.col("value")))
    return census.cc0(rows, "p_type")


def rebuilt_records(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("record_id"), F.lit("x").alias("data_source"), (F.col("l_linenumber") % 3).alias("depth"), F.when(F.col("l_linenumber") != 4, F.col("l_linenumber")).alias("pos"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.col("l_returnflag").alias("field_type"), F.col("l_linestatus").alias("value"))
    made = census.record_documents(lines)
    return made.select("record_id", F.array_join(F.transform("nodes", lambda n: F.concat(n["node_id"], F.lit(":"), n["field_type"])), ",").alias("nodes"))


def residue_shapes(spark, sf_dir):
    rows = _table(spark, sf_dir, "part").select((F.col("p_partkey") % 2).alias("group"), F.lit("none").alias("reason"), F.expr(_CODE).alias("atom"), F.col("p_size").alias("count"), F.when(F.col("p_size") > 10, "deferred").otherwise("resolved").alias("status"))
    return census.residue(rows)


_FAMILIES = {"object": ("title",), "text": ("descr", "note"), "date": ("count",)}


def record_bags(spark, sf_dir):
    return retrieval.text_index(_catalogue(spark, sf_dir), _FAMILIES)


def year_bounds(spark, sf_dir):
    return retrieval.date_index(_catalogue(spark, sf_dir), ("made", "objnum"))


def ranked_records(spark, sf_dir):
    nodes = _catalogue(spark, sf_dir)
    return retrieval.ranked(retrieval.text_index(nodes, _FAMILIES), retrieval.date_index(nodes.where("record_id % 3 > 0"), ("made",)), [("object", "red widg"), ("text", "red"), ("date", 1950, 1980)])


_SIZES = """CASE p_partkey % 6 WHEN 0 THEN concat({s}, ' x ', {k}, 'cm') WHEN 1 THEN concat('height: ', {s}, ' mm; width: ', {k}, ' mm') WHEN 2 THEN concat({s}, ' ft ', {k}, ' in') WHEN 3 THEN concat('weight ', {s}, '-', {m}, ' kg') WHEN 4 THEN concat('frame: ', {s}, ' x ', {k}, ' x 2 in; 1 slide') ELSE concat('about ', {s}, '½" (', {m}, ' mm)') END""".format(s="CAST(p_size AS VARCHAR(9))", k="CAST(p_partkey % 11 AS VARCHAR(9))", m="CAST(p_size + 20 AS VARCHAR(9))")


def parsed_dimensions(spark, sf_dir):
    rows = _table(spark, sf_dir, "part").select(F.expr(_SIZES).alias("raw")).groupBy("raw").agg(F.count("*").alias("n")).withColumn("d", D.dimensions(F.col("raw")))
    m = lambda k: F.get("d.measurements", F.lit(k))
    show = lambda x: F.concat_ws("|", x["dimension_type"], F.round(x["dimension_value"], 4).cast("decimal(12,4)").cast("string"), x["dimension_measurement_unit"], x["dimension_value_qualifier"], x["dimension_measured_part"])
    return rows.select("raw", "n", "d.status", F.size("d.measurements").alias("parts"), show(m(0)).alias("first"), show(m(1)).alias("second"), F.round(D.base_magnitude(m(0)["dimension_value"], m(0)["dimension_measurement_unit"]), 4).alias("base"))


_PERSON = """CASE c_custkey % 6 WHEN 0 THEN concat({w}, ', John Henry') WHEN 1 THEN concat({w}, ', Dr Ann, OBE') WHEN 2 THEN concat({w}, '/Mary<M.A') WHEN 3 THEN concat({w}, ', Jan van der') WHEN 4 THEN concat({w}, ' & Sons') ELSE concat({w}, ', J., Former owner') END""".format(w="concat(substring(c_mktsegment, 1, 1), lower(substring(c_mktsegment, 2, 20)))")


def parsed_persons(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select(F.expr(_PERSON).alias("raw")).groupBy("raw").agg(F.count("*").alias("n")).withColumn("p", persons.person(F.col("raw")))
    return rows.select("raw", "n", "p.entity", "p.convention", "p.reason", "p.prefix", "p.given", "p.middle", "p.surname", "p.suffix", "p.display")


_DOUBT = """CASE p_partkey % 7 WHEN 0 THEN concat(p_name, '?') WHEN 1 THEN concat('[', p_name, ']') WHEN 2 THEN concat('Probably ', p_name) WHEN 3 THEN concat(p_name, ' (possibly)') WHEN 4 THEN concat('c. ', CAST(p_partkey AS VARCHAR(9))) WHEN 5 THEN concat('perhaps ', p_name, ' (?)') ELSE p_name END"""


def parsed_certainty(spark, sf_dir):
    rows = _table(spark, sf_dir, "part").select(F.expr(_DOUBT).alias("raw")).groupBy("raw").agg(F.count("*").alias("n")).withColumn("c", parsers.certainty(F.col("raw")))
    return rows.select("raw", "n", "c.clean", "c.notation")


_RECORD = """concat('{{"@admin":{{"uuid":"u', p_partkey % 700, '","processed":', p_partkey, ',"odd":', p_size, ',"data_source":{{"name":"', p_brand, '"}}}},"@document":{{"units":[{{"label":"a","value":"', p_name, '","units":[{{"label":"b","value":"', p_type, '"}}]}},{{"label":"c","value":', p_size, '}}]}}}}')""".replace("{{", "{").replace("}}", "}")


def flattened_units(spark, sf_dir):
    """The newest copy of each record, flattened."""
    lines = _table(spark, sf_dir, "part").select(F.expr(_RECORD).alias("value"), F.col("p_partkey").alias("ordinal"))
    rows = records.newest(records.parse_records(lines, "ordinal"), "record_id", "processed", "ordinal")
    return records.flatten(rows).select("record_id", "data_source", "node_id", "parent_id", "depth", "label", "value")


def spilled_keys(spark, sf_dir):
    lines = _table(spark, sf_dir, "part").select(F.expr(_RECORD).alias("value"), F.col("p_partkey").alias("ordinal"))
    return records.parse_records(lines, "ordinal").select("ordinal", "extra")


def vocabulary_terms(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    lines = part.select(F.expr("concat('<http://v.org/', p_partkey % 300, '> <http://v.org/x#prefLabel> <http://v.org/term/', p_partkey, '> .')").alias("value"))
    terms = part.select(F.expr(r"""concat('<http://v.org/term/', p_partkey, '> <http://v.org/x#text> "', p_name, CASE WHEN p_partkey % 3 = 0 THEN ' \\u00e9' ELSE '' END, '"', CASE WHEN p_partkey % 2 = 0 THEN '@en' ELSE '' END, ' .')""").alias("value"))
    return records.term_index(records.parse_triples(lines.union(terms)), ("http://v.org/x#prefLabel",), "http://v.org/x#text")


QUERIES = {
    f.__name__: f
    for f in (
        conformance, disguised_nulls, interval_statuses, placed_in_context, ancestor_terms, sole_suppliers, separator_candidates, separator_scores, merged_patterns, field_coverage, source_coverage,
        owning_stages, marker_styles, year_cohorts, field_years, record_richness, extraction_queue, review_strata, routed_values, relaxed_union, word_set_changes, consensus_events, licensed_nodes,
        rebuilt_records, residue_shapes, record_bags, year_bounds, ranked_records, parsed_dimensions, parsed_persons, parsed_certainty, flattened_units, spilled_keys, vocabulary_terms,
    )
}

_RICH = """n AS (SELECT o_orderkey AS record_id, o_orderpriority AS data_source, 'status' AS field_type, o_orderstatus AS value, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
  UNION ALL SELECT o_orderkey, o_orderpriority, 'total', CASE WHEN o_custkey % 3 > 0 THEN CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) END, CAST(year(o_orderdate) AS INTEGER) FROM orders),
own AS (SELECT * FROM n WHERE length(trim(value)) > 0),
rec AS (SELECT record_id, min(data_source) AS data_source, min(year) AS year, count(*) AS n_fields, count(DISTINCT field_type) AS n_distinct_fields, CAST(sum(length(value)) AS BIGINT) AS total_chars FROM own GROUP BY 1)"""
_LIST = f"""l AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'even' ELSE 'odd' END AS "group", p_brand AS data_source, {_LISTED} AS value, count(*) AS count FROM part GROUP BY 1, 2, 3),
v AS (SELECT *, trim(regexp_replace(lower(value), '\\s+', ' ', 'g')) AS norm FROM l)"""
_ANN = f"""a AS (SELECT l_returnflag AS field_type, l_suppkey % 10 AS data_source, l_linestatus AS "group", l_partkey % 900 AS value, {_STATUS.replace("l_partkey", "(l_partkey % 900)")} AS status FROM lineitem), act AS (SELECT * FROM a WHERE status <> 'rejected')"""

ORACLE_SQL = {
    "conformance": f"""WITH {_CATALOGUE_SQL}, own AS (SELECT * FROM cat WHERE value IS NOT NULL),
f AS (SELECT record_id, data_source, min(value) FILTER (field_type = 'title') AS title, min(value) FILTER (field_type = 'descr') AS descr, min(value) FILTER (field_type = 'objnum') AS objnum,
  bool_or(regexp_matches(value, '</?[A-Za-z][^<>]*>')) AS html, bool_or(regexp_matches(value, '&(?:amp|lt|gt|quot|apos|nbsp|#[0-9]+|#x[0-9a-fA-F]+);')) AS enc, bool_or(field_type IN ('descr', 'note')) AS has_text,
  bool_or(field_type IN ('descr', 'note') AND regexp_matches(value, '^\\s*https?://\\S+\\s*$')) AS uri, max(CASE WHEN field_type = 'made' THEN TRY_CAST(regexp_extract(value, '([0-9]{{3,4}})', 1) AS INTEGER) END) AS y,
  bool_or(field_type = 'note') AS unknown, count(*) FILTER (field_type IN ('count', 'objnum')) AS nt, count(*) FILTER ((field_type = 'objnum' AND regexp_matches(value, '^[1-9][0-9]*$')) OR (field_type = 'count' AND regexp_matches(value, '^-?[0-9]+(\\.[0-9]+)?$'))) AS nok
  FROM own GROUP BY 1, 2),
d AS (SELECT record_id, bool_or(n > 1) AS dup FROM (SELECT record_id, field_type, value, count(*) AS n FROM own GROUP BY 1, 2, 3) GROUP BY 1),
c AS (SELECT f.*, dup, count(*) OVER (PARTITION BY data_source, title) AS tc FROM f JOIN d USING (record_id)),
k AS (SELECT record_id, data_source, nt, nok, tc < 25 AS pass_reuse, trim(lower(title)) <> trim(lower(descr)) AS pass_near_identical, NOT dup AS pass_duplicate_stmt, regexp_matches(title, '[A-Za-z]{{3,}}') AND title <> objnum AS pass_nondescriptive_title,
  CASE WHEN has_text THEN NOT uri END AS pass_uri_only_text, length(descr) >= 20 AS pass_short_descr, length(title) <= 150 AS pass_long_title, y <= 2026 AS pass_impossible_date, NOT html AS pass_html, NOT enc AS pass_encoding, NOT unknown AS pass_schema_field FROM c)
SELECT record_id, data_source, round((nok + list_count(list_filter([pass_reuse, pass_near_identical, pass_duplicate_stmt, pass_nondescriptive_title, pass_uri_only_text, pass_short_descr, pass_long_title, pass_impossible_date, pass_html, pass_encoding, pass_schema_field], lambda x: x)))
  / (nt + list_count([pass_reuse, pass_near_identical, pass_duplicate_stmt, pass_nondescriptive_title, pass_uri_only_text, pass_short_descr, pass_long_title, pass_impossible_date, pass_html, pass_encoding, pass_schema_field])), 9) AS conformance,
  pass_reuse, pass_near_identical, pass_duplicate_stmt, pass_nondescriptive_title, pass_uri_only_text, pass_short_descr, pass_long_title, pass_impossible_date, pass_html, pass_encoding, pass_schema_field, round(nok / nt, 9) AS pass_model_typed FROM k""",
    "disguised_nulls": f"""WITH {_CATALOGUE_SQL}, c AS (SELECT data_source, field_type, lower(trim(value)) AS value_norm, count(*) AS occ FROM cat WHERE value IS NOT NULL AND field_type <> 'objnum' AND trim(value) <> '' GROUP BY 1, 2, 3),
r AS (SELECT *, occ / sum(occ) OVER (PARTITION BY data_source, field_type) AS share FROM c), u AS (SELECT data_source, value_norm, count(DISTINCT field_type) AS n FROM c WHERE occ >= 1 GROUP BY 1, 2)
SELECT data_source, field_type, value_norm, occ, round(share, 9) AS share, coalesce(n, 0) AS n_fields_reused, value_norm = 'many' AS seed_match FROM r LEFT JOIN u USING (data_source, value_norm)
WHERE value_norm = 'many' OR (share >= 0.0005 AND occ >= 2 AND n >= 2)""",
    "interval_statuses": """WITH c AS (SELECT l_orderkey AS record_id, l_linenumber AS node, l_partkey % 40 AS lo, l_partkey % 40 + l_suppkey % 9 AS hi FROM lineitem WHERE l_linenumber > 1),
s AS (SELECT l_orderkey AS record_id, l_partkey % 40 AS slo, l_partkey % 40 + l_suppkey % 9 AS shi FROM lineitem WHERE l_linenumber = 1 AND l_returnflag <> 'N')
SELECT node, record_id, CASE WHEN count(slo) = 0 AND record_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') THEN 'unparsed_field' WHEN count(slo) = 0 THEN 'novel'
  WHEN bool_or(lo <= slo AND hi >= shi) THEN 'echo' WHEN bool_or(lo >= slo AND hi <= shi AND (lo <> slo OR hi <> shi)) THEN 'refine' ELSE 'additional' END AS status
FROM c LEFT JOIN s USING (record_id) GROUP BY 1, 2""",
    "placed_in_context": """WITH i AS (SELECT string_split(p_name, ' ')[1] AS head, p_partkey AS subject, [lower(p_type), lower(p_brand)] AS known, CAST(p_size * CASE WHEN p_partkey % 100 = 0 THEN 9000 ELSE 1 END AS BIGINT) AS prominence FROM part),
ix AS (SELECT * FROM i WHERE subject % 3 = 0 OR prominence > 40),
t AS (SELECT p_partkey AS norm, string_split(p_name, ' ')[1] AS head, CASE p_partkey % 4 WHEN 0 THEN [] WHEN 1 THEN [lower(p_type), lower(p_brand)] ELSE [lower(p_brand)] END AS context FROM part),
c AS (SELECT *, list_has_all(known, context) AS f FROM t JOIN ix USING (head)),
r AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY prominence DESC, subject) AS k, row_number() OVER (PARTITION BY norm, f ORDER BY prominence DESC, subject) AS kf FROM c),
g AS (SELECT norm, any_value(len(context)) > 0 AS stated, count(DISTINCT subject) AS n_candidates, count(*) FILTER (f) AS n_full, max(subject) FILTER (f AND kf = 1) AS sf, max(subject) FILTER (k = 1) AS st, max(prominence) FILTER (k = 1) AS p0, coalesce(max(prominence) FILTER (k = 2), 0) AS p1 FROM r GROUP BY 1)
SELECT norm, n_candidates, n_full, coalesce(sf, st) AS subject, CASE WHEN stated AND n_full = 1 THEN 'context_full' WHEN stated THEN NULL WHEN n_candidates = 1 THEN 'unique' WHEN p0 >= 1000 AND p0 >= 10 * (p1 + 1) THEN 'prominent' END AS resolved_by FROM g""",
    "ancestor_terms": """WITH n AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey AS subject, lower(n_name) AS norm FROM customer JOIN n ON c_nationkey = n_nationkey WHERE c_acctbal > 0 AND n_nationkey < 5
UNION SELECT c_custkey, lower(r_name) FROM customer JOIN n ON c_nationkey = n_nationkey WHERE c_acctbal > 0""",
    "sole_suppliers": """SELECT o_custkey AS subject, min(l_suppkey) AS supplier FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_quantity > 40 GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1""",
    "separator_candidates": f"""WITH {_LIST}, m AS (SELECT *, string_split_regex(regexp_replace(regexp_replace(value, '[A-Za-z]', 's', 'g'), '[0-9]', 'd', 'g'), '[ds]+') AS p FROM v),
e AS (SELECT "group", data_source, value, count, unnest(p[2:len(p) - 1]) AS piece FROM m WHERE len(p) > 2), b AS (SELECT *, regexp_replace(piece, '\\s+', ' ', 'g') AS q FROM e),
o AS (SELECT DISTINCT "group", data_source, value, count, CASE WHEN trim(q) IN ('-', '''', '’') AND q <> trim(q) THEN concat(' ', trim(q), ' ') ELSE trim(q) END AS separator FROM b),
lit AS (SELECT "group", separator, CAST(sum(count) AS BIGINT) AS records, count(*) AS n_values, CASE WHEN separator = '' THEN 'whitespace' ELSE 'literal' END AS kind FROM o WHERE NOT regexp_matches(separator, '[\\p{{L}}\\p{{N}}]') GROUP BY 1, 2),
w AS (SELECT "group", unnest(list_distinct(regexp_extract_all(lower(value), '[a-z]{{2,}}'))) AS separator, count FROM v), wc AS (SELECT "group", separator, CAST(sum(count) AS BIGINT) AS records, count(*) AS n_values FROM w GROUP BY 1, 2),
wh AS (SELECT "group", norm AS separator, sum(count) AS whole FROM v GROUP BY 1, 2),
con AS (SELECT "group", separator, records, n_values, 'word' AS kind FROM wc LEFT JOIN wh USING ("group", separator) WHERE records >= 50 AND coalesce(whole, 0) <= 0.02 * records)
SELECT *, CASE WHEN kind = 'literal' THEN CASE WHEN records < 100 THEN 'support' WHEN regexp_matches(separator, '[()\\[\\]{{}}"''«»]') THEN 'pairing mark' WHEN contains(separator, ';') OR contains(separator, '|') THEN 'base separator'
  WHEN separator IN ('-', '''', '’') OR contains(separator, '.') THEN 'word orthography' WHEN contains(separator, '?') THEN 'uncertainty mark' END WHEN kind = 'word' THEN CASE WHEN separator NOT IN ('and', 'or') THEN 'content word' END ELSE 'whitespace' END AS reason
FROM (SELECT * FROM lit UNION ALL SELECT * FROM con)""",
    "separator_scores": f"""WITH {_LIST}, att AS (SELECT "group", norm FROM v GROUP BY 1, 2 HAVING sum(count) >= 2), s AS (SELECT unnest(['/', 'and', '&']) AS separator),
m AS (SELECT "group", data_source, separator, count, list_filter(list_transform(string_split(value, CASE WHEN separator = 'and' THEN ' and ' ELSE separator END), lambda x: trim(x)), lambda x: x <> '') AS f FROM v, s WHERE contains(value, CASE WHEN separator = 'and' THEN ' and ' ELSE separator END)),
g AS (SELECT * FROM m WHERE len(f) >= 2), sup AS (SELECT "group", data_source, separator, CAST(sum(count) AS BIGINT) AS support_records, CAST(sum(len(f) * count) AS BIGINT) AS frags_total FROM g GROUP BY 1, 2, 3),
x AS (SELECT "group", data_source, separator, count, unnest(f) AS frag FROM g),
kn AS (SELECT x."group", data_source, separator, CAST(sum(count) AS BIGINT) AS frags_attested, count(DISTINCT norm) AS n_fragments FROM x JOIN att ON att."group" = x."group" AND norm = trim(regexp_replace(lower(frag), '\\s+', ' ', 'g')) GROUP BY 1, 2, 3)
SELECT *, attestation >= 0.5 AND n_fragments >= 2 AND support_records >= 5 AS is_separator FROM (SELECT "group", data_source, separator, support_records, frags_total, coalesce(frags_attested, 0) AS frags_attested, coalesce(n_fragments, 0) AS n_fragments, round(coalesce(frags_attested, 0) / frags_total, 9) AS attestation
FROM sup LEFT JOIN kn USING ("group", data_source, separator))""",
    "merged_patterns": f"""WITH o AS (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN 'date' ELSE 'code' END AS merge_group, {_CODE} AS value FROM part),
r AS (SELECT *, regexp_extract_all(regexp_replace(regexp_replace(value, '[A-Za-z]', 's', 'g'), '[0-9]', 'd', 'g'), 'd+|s+|[\\s\\S]') AS runs FROM o),
p AS (SELECT *, array_to_string(list_transform(runs, lambda x: CASE WHEN x[1] IN ('d', 's') THEN concat(x[1], '{{', length(x), '}}') ELSE x END), '') AS pattern,
  CASE WHEN len(runs) = 1 THEN concat('L', length(value)) ELSE array_to_string(list_transform(runs, lambda x: CASE WHEN x[1] NOT IN ('d', 's') THEN '.' WHEN length(x) >= 3 THEN 'W' ELSE 'N' END), '') END AS sig FROM r),
q AS (SELECT *, CASE WHEN merge_group = 'date' THEN concat(regexp_replace(pattern, '\\{{[0-9]+\\}}', '', 'g'), '#', sig) ELSE regexp_replace(pattern, '\\{{[0-9]+\\}}', '', 'g') END AS key FROM p),
d AS (SELECT merge_group, key, pattern, regexp_extract_all(value, '[0-9]+') AS ds FROM q), s AS (SELECT merge_group, key, pattern, unnest(ds) AS digits, generate_subscripts(ds, 1) - 1 AS slot FROM d),
m AS (SELECT merge_group, key, slot, length(digits) AS slot_len, pattern, median(CAST(digits AS BIGINT)) AS med FROM s GROUP BY ALL),
sp AS (SELECT merge_group, key, slot, max(spread) AS score FROM (SELECT merge_group, key, slot, slot_len, max(med) - min(med) AS spread FROM m GROUP BY ALL) GROUP BY ALL),
w AS (SELECT merge_group, key, arg_min(slot, (-score, slot)) AS slot FROM sp GROUP BY ALL HAVING max(score) >= 50),
g AS (SELECT m.*, med - lag(med) OVER (PARTITION BY merge_group, key, slot_len ORDER BY med, pattern) AS gap FROM m JOIN w USING (merge_group, key, slot)),
b AS (SELECT *, coalesce(CAST(gap = max(gap) OVER (PARTITION BY merge_group, key, slot_len) AS INTEGER), 0) AS cut FROM g),
sm AS (SELECT merge_group, key, pattern, concat(slot_len, ':', sum(cut) OVER (PARTITION BY merge_group, key, slot_len ORDER BY med, pattern)) AS split FROM b),
z AS (SELECT q.*, coalesce(split, '') AS split FROM q LEFT JOIN sm USING (merge_group, key, pattern)), zr AS (SELECT DISTINCT merge_group, key, split, pattern, runs FROM z),
e AS (SELECT merge_group, key, split, unnest(runs) AS run, generate_subscripts(runs, 1) AS pos FROM zr),
t AS (SELECT merge_group, key, split, pos, min(run[1]) AS c, min(length(run)) AS lo, max(length(run)) AS hi FROM e GROUP BY ALL),
mp AS (SELECT merge_group, key, split, string_agg(CASE WHEN c NOT IN ('d', 's') THEN c WHEN lo = hi THEN concat(c, '{{', lo, '}}') ELSE concat(c, '{{', lo, ',', hi, '}}') END, '' ORDER BY pos) AS merged_pattern FROM t GROUP BY ALL)
SELECT merge_group, value, merged_pattern FROM z JOIN mp USING (merge_group, key, split)""",
    "field_coverage": f"""WITH {_ANN} SELECT field_type, count(*) AS occurrences, round(avg(CAST(status = 'resolved' AS INTEGER)), 9) AS resolved, round(avg(CAST(status = 'flagged' AS INTEGER)), 9) AS flagged, round(avg(CAST(status = 'deferred' AS INTEGER)), 9) AS deferred,
avg(CAST(status = 'resolved' AS INTEGER)) >= 0.85 AS meets_target FROM act GROUP BY 1""",
    "source_coverage": f"""WITH {_ANN}, d AS (SELECT data_source, "group", value, min(status) AS status FROM act GROUP BY 1, 2, 3)
SELECT * FROM (SELECT data_source, "group", count(*) AS occurrences, round(avg(CAST(status = 'resolved' AS INTEGER)), 9) AS resolved_occ FROM act GROUP BY 1, 2) JOIN (SELECT data_source, "group", count(*) AS "distinct", round(avg(CAST(status = 'resolved' AS INTEGER)), 9) AS resolved_distinct FROM d GROUP BY 1, 2) USING (data_source, "group")""",
    "owning_stages": """WITH r AS (SELECT l_partkey % 50 AS field_type, l_suppkey % 10 AS data_source, CASE WHEN l_linenumber < 3 THEN concat('c', l_suppkey % 3) END AS component,
  CASE WHEN l_partkey % 50 < 10 OR l_quantity > 30 THEN 'untouched' WHEN l_quantity > 20 THEN 'verified' WHEN l_quantity > 10 THEN 'applied' ELSE 'qualified' END AS disposition FROM lineitem),
f AS (SELECT field_type, count(*) AS occ, count(DISTINCT data_source) AS institutions, count(*) FILTER (disposition = 'applied') AS applied, count(*) FILTER (disposition = 'qualified') AS qualified, count(*) FILTER (disposition = 'deferred') AS deferred,
  count(*) FILTER (disposition = 'enriched') AS enriched, count(*) FILTER (disposition = 'verified') AS verified, count(*) FILTER (disposition = 'untouched') AS untouched, avg(CAST(disposition IN ('applied', 'qualified', 'deferred') AS INTEGER)) AS ws FROM r GROUP BY 1),
o AS (SELECT field_type, coalesce(component, 'unattributed') AS c, count(*) AS n FROM r WHERE disposition IN ('applied', 'qualified', 'deferred') GROUP BY 1, 2), w AS (SELECT field_type, c, n FROM o QUALIFY row_number() OVER (PARTITION BY field_type ORDER BY n DESC, c) = 1)
SELECT field_type, occ, institutions, applied, qualified, deferred, enriched, verified, untouched, round(ws, 9) AS worked_share, CASE WHEN ws >= 0.05 THEN c END AS owning_stage, round(CASE WHEN ws >= 0.05 THEN n / occ END, 9) AS owning_stage_share FROM f LEFT JOIN w USING (field_type)""",
    "marker_styles": """WITH r AS (SELECT source AS data_source, count(*) AS n_values, avg(CAST(contains(text, '?') AS INTEGER)) AS question, avg(CAST(contains(text, '[') AS INTEGER)) AS brackets, avg(CAST(contains(text, 'http') AS INTEGER)) AS links FROM documents WHERE text IS NOT NULL GROUP BY 1),
s AS (SELECT *, concat_ws(' ', CASE WHEN question >= 0.02 THEN 'question' END, CASE WHEN brackets >= 0.02 THEN 'brackets' END, CASE WHEN links >= 0.02 THEN 'links' END) AS st FROM r)
SELECT data_source, n_values, round(question, 9) AS question, round(brackets, 9) AS brackets, round(links, 9) AS links, CASE WHEN st = '' THEN 'no marker' ELSE st END AS style FROM s""",
    "year_cohorts": f"WITH {_RICH}, c AS (SELECT data_source, year, count(*) AS n FROM rec GROUP BY 1, 2) SELECT data_source, CAST(sum(n) AS BIGINT) AS records, count(*) AS year_buckets, min(year) AS y0, max(year) AS y1 FROM c GROUP BY 1",
    "field_years": f"WITH {_RICH} SELECT data_source, year, field_type, count(DISTINCT record_id) AS n_with_field FROM own GROUP BY 1, 2, 3",
    "record_richness": f"WITH {_RICH} SELECT * FROM rec",
    "extraction_queue": f"""WITH {_CATALOGUE_SQL}, r AS (SELECT record_id, CAST(coalesce(sum(length(value)) FILTER (field_type IN ('descr', 'title')), 0) AS BIGINT) AS text_chars, bool_or(field_type = 'note') AS has_note, bool_or(field_type = 'made') AS has_made, bool_or(field_type = 'size') AS has_size FROM cat WHERE value IS NOT NULL GROUP BY 1),
q AS (SELECT *, CAST(NOT has_note AS INTEGER) + CAST(NOT has_made AS INTEGER) + CAST(NOT has_size AS INTEGER) AS n_missing FROM r), k AS (SELECT *, row_number() OVER (ORDER BY n_missing DESC, text_chars DESC, record_id) - 1 AS priority FROM q WHERE text_chars >= 20 AND n_missing > 0)
SELECT record_id, text_chars, n_missing, has_note, has_made, has_size, priority, priority // 100 AS shard FROM k""",
    "review_strata": """WITH r AS (SELECT p_partkey, p_brand AS stratum, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) <= 5 AS head, row_number() OVER (PARTITION BY p_brand ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) <= 5 AS drawn FROM part) SELECT * FROM r WHERE head OR drawn""",
    "routed_values": """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'null_marker' WHEN 1 THEN CASE WHEN p_brand = 'Brand#11' THEN 'bilingual' ELSE 'cascade' END WHEN 2 THEN 'semantic_marker'
WHEN 3 THEN CASE WHEN length(repeat(concat(p_name, ' '), 13)) > 200 OR len(string_split(repeat(concat(p_name, ' '), 13), ' ')) > 25 THEN 'prose' ELSE 'cascade' END ELSE 'cascade' END AS route FROM part""",
    "relaxed_union": "SELECT CAST(s_suppkey AS BIGINT) AS key, s_name AS name, CAST(s_nationkey AS VARCHAR) AS extra, NULL AS segment FROM supplier UNION ALL SELECT c_custkey, NULL, c_name, c_mktsegment FROM customer",
    "word_set_changes": """WITH r AS (SELECT p_partkey, string_split(p_name, ' ') AS a, string_split(concat(string_split(p_name, ' ')[1], ' ', lower(p_type)), ' ') AS b FROM part)
SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(a, lambda x: NOT list_contains(b, x)))), ' ') AS gone, array_to_string(list_sort(list_distinct(list_filter(b, lambda x: NOT list_contains(a, x)))), ' ') AS new,
array_to_string(list_sort(list_intersect(a, b)), ' ') AS same, array_to_string(list_sort(list_distinct(list_concat(a, b))), ' ') AS "all" FROM r""",
    "consensus_events": """WITH s AS (SELECT l_suppkey % 20 AS data_source, 1900 + (l_partkey * 7) % 300 AS year, concat('f', l_orderkey) AS signal, l_discount + 0.01 AS effect, (l_discount + 0.01) * log10(CAST(greatest(10, least(l_partkey, l_orderkey)) AS DOUBLE)) AS w FROM lineitem WHERE l_quantity > 49 AND l_linenumber = 1),
b AS (SELECT *, CASE WHEN year - lag(year) OVER (PARTITION BY data_source ORDER BY year) <= 1 THEN 0 ELSE 1 END AS starts FROM s), c AS (SELECT *, sum(starts) OVER (PARTITION BY data_source ORDER BY year RANGE UNBOUNDED PRECEDING) AS event FROM b)
SELECT data_source, CAST(round(sum(w * year) / sum(w)) AS INTEGER) AS event_year, round(sum(w), 2) AS evidence, count(*) AS n_fields, arg_max(signal, (effect, signal)) AS top_field FROM c GROUP BY data_source, event""",
    "licensed_nodes": f"WITH {PART_NODES_SQL}, c AS (SELECT record_id, data_source, field_type, CASE WHEN field_type = 'p_type' AND value LIKE 'E%' THEN 'CC 0' ELSE value END AS value FROM nodes) SELECT * FROM c WHERE record_id IN (SELECT record_id FROM c WHERE field_type = 'p_type' AND value = 'CC 0')",
    "rebuilt_records": "SELECT l_orderkey AS record_id, string_agg(concat(l_orderkey, '/', l_linenumber, ':', l_returnflag), ',' ORDER BY l_linenumber % 3, CASE WHEN l_linenumber = 4 THEN 1000 ELSE l_linenumber END, l_returnflag) AS nodes FROM lineitem GROUP BY 1",
    "residue_shapes": f"""WITH r AS (SELECT p_partkey % 2 AS "group", 'none' AS reason, {_CODE} AS atom, p_size AS count FROM part WHERE p_size > 10), s AS (SELECT *, regexp_replace(regexp_replace(atom, '[A-Za-z]+', 's', 'g'), '[0-9]+', 'd', 'g') AS shape FROM r)
SELECT "group", reason, shape, count(*) AS "distinct", CAST(sum(count) AS BIGINT) AS occurrences, list_sort(list_distinct(list(atom)))[1:3] AS examples FROM s GROUP BY 1, 2, 3""",
    "record_bags": f"""WITH {_CATALOGUE_SQL}, r AS (SELECT record_id, data_source, CASE field_type WHEN 'title' THEN 'object' WHEN 'descr' THEN 'text' WHEN 'note' THEN 'text' WHEN 'count' THEN 'date' END AS family, trim(regexp_replace(lower(value), '[^0-9a-z]+', ' ', 'g')) AS term FROM cat WHERE value IS NOT NULL)
SELECT record_id, data_source, family, array_to_string(list_sort(list_distinct(list(term))), ' ') AS bag FROM r WHERE family IS NOT NULL AND term <> '' GROUP BY 1, 2, 3""",
    "year_bounds": f"""WITH {_CATALOGUE_SQL}, y AS (SELECT record_id, TRY_CAST(regexp_extract(value, '(-?[0-9]{{3,4}})', 1) AS INTEGER) AS y FROM cat WHERE field_type IN ('made', 'objnum')) SELECT record_id, min(y) AS year_lo, max(y) AS year_hi FROM y WHERE abs(y) <= 2100 GROUP BY 1""",
    "ranked_records": f"""WITH {_CATALOGUE_SQL}, f AS (SELECT record_id, data_source, CASE field_type WHEN 'title' THEN 'object' WHEN 'descr' THEN 'text' WHEN 'note' THEN 'text' WHEN 'count' THEN 'date' END AS family, concat(' ', trim(regexp_replace(lower(value), '[^0-9a-z]+', ' ', 'g'))) AS t FROM cat WHERE value IS NOT NULL),
y AS (SELECT record_id, min(TRY_CAST(regexp_extract(value, '(-?[0-9]{{3,4}})', 1) AS INTEGER)) AS lo, max(TRY_CAST(regexp_extract(value, '(-?[0-9]{{3,4}})', 1) AS INTEGER)) AS hi FROM cat WHERE field_type = 'made' AND record_id % 3 > 0 GROUP BY 1),
g AS (SELECT record_id, family, string_agg(t, '') AS b FROM f GROUP BY 1, 2),
h AS (SELECT record_id FROM g WHERE family = 'object' AND contains(b, ' red') AND contains(b, ' widg') UNION ALL SELECT record_id FROM g WHERE family = 'text' AND contains(b, ' red') UNION ALL SELECT record_id FROM y WHERE lo <= 1980 AND hi >= 1950
  UNION ALL SELECT DISTINCT record_id FROM f WHERE family = 'date' AND record_id % 3 = 0 AND TRY_CAST(regexp_extract(t, '([0-9]{{3,4}})', 1) AS INTEGER) BETWEEN 1950 AND 1980)
SELECT h.record_id, count(*) AS n_matched, any_value(p_brand) AS data_source FROM h JOIN part ON p_partkey = h.record_id GROUP BY 1 ORDER BY n_matched DESC, h.record_id LIMIT 25""",
    "parsed_dimensions": f"""WITH r AS (SELECT p_partkey % 6 AS k, p_size AS s, p_partkey % 11 AS w, {_SIZES} AS raw FROM part), g AS (SELECT raw, k, s, any_value(w) AS w, count(*) AS n FROM r GROUP BY 1, 2, 3),
f AS (SELECT *, CAST(CAST(s AS DECIMAL(12,4)) AS VARCHAR) AS a, CAST(CAST(w AS DECIMAL(12,4)) AS VARCHAR) AS b, CAST(CAST(s + 20 AS DECIMAL(12,4)) AS VARCHAR) AS c FROM g)
SELECT raw, n, CASE WHEN k = 4 THEN 'partial' ELSE 'resolved' END AS status, CASE k WHEN 2 THEN 1 WHEN 4 THEN 3 ELSE 2 END AS parts,
  CASE k WHEN 0 THEN concat('height|', a, '|cm') WHEN 1 THEN concat('height|', a, '|mm') WHEN 2 THEN concat(CAST(CAST(s * 12 + w AS DECIMAL(12,4)) AS VARCHAR), '|in') WHEN 3 THEN concat('weight|', a, '|kg|minimum') WHEN 4 THEN concat('height|', a, '|in|frame') ELSE concat(CAST(CAST(s + 0.5 AS DECIMAL(12,4)) AS VARCHAR), '|in|approx') END AS first,
  CASE k WHEN 0 THEN concat('width|', b, '|cm') WHEN 1 THEN concat('width|', b, '|mm') WHEN 2 THEN '' WHEN 3 THEN concat('weight|', c, '|kg|maximum') WHEN 4 THEN concat('width|', b, '|in|frame') ELSE concat(c, '|mm|parenthetical') END AS second,
  round(CASE k WHEN 0 THEN s * 10.0 WHEN 1 THEN s * 1.0 WHEN 2 THEN (s * 12 + w) * 25.4 WHEN 3 THEN s * 1000.0 WHEN 4 THEN s * 25.4 ELSE (s + 0.5) * 25.4 END, 4)::DOUBLE AS base FROM f""",
    "parsed_persons": f"""WITH r AS (SELECT c_custkey % 6 AS k, concat(substring(c_mktsegment, 1, 1), lower(substring(c_mktsegment, 2, 20))) AS w, {_PERSON} AS raw FROM customer)
SELECT raw, count(*) AS n, CASE WHEN k = 4 THEN 'organisation' ELSE 'person' END AS entity, CASE k WHEN 0 THEN 'inverted' WHEN 1 THEN 'inverted_tail' WHEN 2 THEN 'slashed' WHEN 3 THEN 'inverted' WHEN 4 THEN 'and_organisation' ELSE 'plain' END AS convention,
  CASE WHEN k = 5 THEN 'no_convention' END AS reason, CASE WHEN k = 1 THEN 'Dr' END AS prefix, CASE k WHEN 0 THEN 'John' WHEN 1 THEN 'Ann' WHEN 2 THEN 'Mary' WHEN 3 THEN 'Jan' END AS given, CASE WHEN k = 0 THEN 'Henry' END AS middle,
  CASE WHEN k < 3 THEN w WHEN k = 3 THEN concat('van der ', w) END AS surname, CASE k WHEN 1 THEN 'OBE' WHEN 2 THEN 'M.A' END AS suffix,
  CASE k WHEN 0 THEN concat('John Henry ', w) WHEN 1 THEN concat('Dr Ann ', w, ' OBE') WHEN 2 THEN concat('Mary ', w, ' M.A') WHEN 3 THEN concat('Jan van der ', w) WHEN 4 THEN concat(w, ' & Sons') END AS display FROM r GROUP BY raw, k, w""",
    "parsed_certainty": f"""WITH r AS (SELECT p_partkey % 7 AS k, p_name, p_partkey, {_DOUBT} AS raw FROM part)
SELECT raw, count(*) AS n, CASE k WHEN 4 THEN CAST(any_value(p_partkey) AS VARCHAR) WHEN 6 THEN NULL ELSE any_value(p_name) END AS clean, CASE k WHEN 0 THEN '?' WHEN 1 THEN '[]' WHEN 2 THEN 'Probably' WHEN 3 THEN 'possibly' WHEN 4 THEN 'c.' WHEN 5 THEN '(?)+perhaps' END AS notation FROM r GROUP BY raw, k""",
    "flattened_units": """WITH l AS (SELECT concat('u', p_partkey % 700) AS record_id, max(p_partkey) AS p_partkey FROM part GROUP BY 1), p AS (SELECT * FROM l JOIN part USING (p_partkey))
SELECT record_id, p_brand AS data_source, concat(record_id, '/0') AS node_id, NULL AS parent_id, 0 AS depth, 'a' AS label, p_name AS value FROM p UNION ALL SELECT record_id, p_brand, concat(record_id, '/0/0'), concat(record_id, '/0'), 1, 'b', p_type FROM p
UNION ALL SELECT record_id, p_brand, concat(record_id, '/1'), NULL, 0, 'c', CAST(p_size AS VARCHAR) FROM p""",
    "spilled_keys": """SELECT p_partkey AS ordinal, concat('{"@admin.odd":"', p_size, '"}') AS extra FROM part""",
    "vocabulary_terms": """SELECT DISTINCT CAST(p_partkey % 300 AS VARCHAR) AS subject, 'prefLabel' AS kind, concat(p_name, CASE WHEN p_partkey % 3 = 0 THEN ' é' ELSE '' END) AS term, CASE WHEN p_partkey % 2 = 0 THEN 'en' END AS lang, concat(p_name, CASE WHEN p_partkey % 3 = 0 THEN ' é' ELSE '' END) AS norm FROM part""",
}
