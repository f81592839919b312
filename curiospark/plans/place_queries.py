"""Queries of the place names, of numbers that hold years and of pattern heads, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import norm_term
from ..operators import places, profiles, schemes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Expressions that run in both dialects: a nation's name in letters, places, and object numbers of four kinds of source.
_NATION = "translate(n_name, '_0123456789', ' abcdefghij')"
_PLACE = f"""CASE c_custkey % 9 WHEN 0 THEN concat({_NATION}, ', ', r_name) WHEN 1 THEN concat(r_name, ' > ', {_NATION}) WHEN 2 THEN concat('St. ', {_NATION})
WHEN 3 THEN concat({_NATION}, ' (', r_name, ')') WHEN 4 THEN 'Place unknown' WHEN 5 THEN concat('near ', {_NATION}) WHEN 6 THEN concat({_NATION}, ', , ', r_name)
WHEN 7 THEN concat({_NATION}, ': b: c: d: e: f: ', r_name) ELSE {_NATION} END"""
_NUMBER = """CASE o_custkey % 4 WHEN 0 THEN concat(CAST(year(o_orderdate) AS VARCHAR(9)), '.', CAST(o_custkey AS VARCHAR(9))) WHEN 1 THEN concat(CAST(year(o_orderdate) + 5 AS VARCHAR(9)), '.', CAST(o_custkey AS VARCHAR(9)))
WHEN 2 THEN concat('L', CAST(year(o_orderdate) AS VARCHAR(9)), '/', CAST(o_custkey % 90 AS VARCHAR(9))) ELSE concat('X', CAST(o_orderkey AS VARCHAR(9))) END"""
_RECORDED = {"accession_date": "CASE WHEN o_custkey % 4 < 2 AND o_orderkey % 3 > 0 THEN CAST(o_orderdate AS VARCHAR(30)) END", "acquisition_date": "CASE WHEN o_custkey % 4 < 2 THEN concat('bought in ', CAST(year(o_orderdate) + 1 AS VARCHAR(9)), ' or 2050') END"}
_MADE = "CASE WHEN o_orderkey % 2 = 0 THEN concat('made ', CAST(year(o_orderdate) - 30 + o_orderkey % 35 AS VARCHAR(9))) END"


def _places(spark, sf_dir) -> DataFrame:
    joined = _table(spark, sf_dir, "customer").join(_table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey")).join(_table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    counts = joined.groupBy(F.expr(_PLACE).alias("atom")).agg(F.count("*").alias("n"))
    return counts.withColumn("norm", norm_term(F.col("atom"))).withColumn("route", places.place_route(F.col("norm"), ("place unknown",)))


def place_routes(spark, sf_dir):
    return _places(spark, sf_dir).groupBy("route").agg(F.count("*").alias("values"), F.sum("n").alias("occurrences"))


def place_orientations(spark, sf_dir):
    read, unread = places.orientations(_places(spark, sf_dir).where("route = 'hierarchical'"))
    rows = read.withColumn("context", F.array_join("context", "|"))
    return rows.unionByName(unread.withColumn("orientation", F.lit("malformed")), allowMissingColumns=True)


def place_terms(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", F.lower(F.expr(_NATION)).alias("name"))
    even = F.col("n_nationkey") % 2 == 0
    term = lambda text, kind, lang: F.struct(text.alias("term"), kind.alias("kind"), lang.cast("string").alias("lang"))
    terms = F.array(
        term(F.col("name"), F.lit("altLabel"), F.lit("en")),
        term(F.concat(F.lit("saint "), "name"), F.lit("prefLabel"), F.when(even, "fr").otherwise("en-gb")),
        term(F.concat(F.lit("st. "), "name"), F.when(even, "prefLabelGVP").otherwise("unused"), F.lit(None)),
    )
    index = nation.select(F.col("n_nationkey").alias("subject"), F.explode(terms).alias("t")).select("subject", F.col("t.term").alias("norm"), "t.*")
    heads = nation.select(F.explode(F.array(F.col("name"), F.concat(F.lit("st. "), "name"), F.concat(F.lit("st "), "name"))).alias("head"))
    return places.head_terms(index, heads)


def _numbers(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), (F.col("o_custkey") % 12).alias("data_source"), F.expr(_NUMBER).alias("value"))


def _dates(spark, sf_dir) -> DataFrame:
    fields = _RECORDED | {"made": _MADE}
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("field_type"), F.expr(e).alias("value")) for k, e in fields.items()))).alias("p")
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), pairs).select("record_id", "p.*").where("value is not null")


def _encoded(spark, sf_dir) -> DataFrame:
    values = _numbers(spark, sf_dir)
    return schemes.encoded_years(values, schemes.year_slots(values, "data_source"), "data_source")


def number_year_slots(spark, sf_dir):
    return schemes.year_slots(_numbers(spark, sf_dir), "data_source")


def accession_years(spark, sf_dir):
    return schemes.field_years(_dates(spark, sf_dir), tuple(_RECORDED))


def number_years(spark, sf_dir):
    dates = _dates(spark, sf_dir)
    return schemes.year_differences(_encoded(spark, sf_dir), schemes.field_years(dates, tuple(_RECORDED)), schemes.field_years(dates, ("made",)))


def scheme_verdicts(spark, sf_dir):
    values, encoded = _numbers(spark, sf_dir), _encoded(spark, sf_dir)
    coverage = values.join(encoded.select("record_id", "year"), "record_id", "left").groupBy("data_source").agg((F.count("year") / F.count("*")).alias("year_coverage"))
    found = schemes.scheme_verdicts(number_years(spark, sf_dir), schemes.structure(encoded), coverage)
    for name in ("year_coverage", "agree", "early", "late", "impossible", "restart_rate"):
        found = found.withColumn(name, F.round(name, 9))
    return found


def completed_years(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    text = F.when(F.col("p_partkey") % 5 == 0, F.lit("1850")).otherwise(F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0"))
    ceiling = F.when(F.col("p_size") > 3, (1900 + F.col("p_size") * 2).cast("int"))
    return part.select("p_partkey", schemes.complete_year(text, ceiling).alias("year"))


def pattern_head_floors(spark, sf_dir):
    nodes = _numbers(spark, sf_dir).withColumn("field_type", F.lit("number"))
    return profiles.head_floors(nodes, (0.02, 0.05, 0.10)).withColumn("divergent_share", F.round("divergent_share", 9))


QUERIES = {f.__name__: f for f in (place_routes, place_orientations, place_terms, number_year_slots, accession_years, number_years, scheme_verdicts, completed_years, pattern_head_floors)}

_AT = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_ORDERS = """o AS (SELECT o_orderkey AS record_id, o_custkey % 12 AS data_source, o_custkey % 4 AS k, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
enc AS (SELECT record_id, data_source, y + CASE WHEN k = 1 THEN 5 ELSE 0 END AS year, CASE k WHEN 2 THEN concat('L', y, '/', o_custkey % 90) WHEN 1 THEN concat(y + 5, '.', o_custkey) ELSE concat(y, '.', o_custkey) END AS value,
  CASE k WHEN 2 THEN o_custkey % 90 ELSE o_custkey END AS tail, CASE WHEN k < 2 THEN CASE WHEN record_id % 3 > 0 THEN y ELSE y + 1 END END AS recorded, CASE WHEN record_id % 2 = 0 THEN CAST(y - 30 + record_id % 35 AS INTEGER) END AS made FROM o WHERE k < 3),
d AS (SELECT record_id, data_source, year, value, tail, CAST(year - recorded AS INTEGER) AS recorded_diff, CAST(year - made AS INTEGER) AS production_diff FROM enc)"""

ORACLE_SQL = {
    "place_routes": f"""WITH v AS (SELECT {_PLACE} AS atom, min(CASE c_custkey % 9 WHEN 4 THEN 'semantic_marker' WHEN 5 THEN 'residue' WHEN 2 THEN 'simple' WHEN 8 THEN 'simple' ELSE 'hierarchical' END) AS route, count(*) AS n FROM {_AT} GROUP BY 1)
SELECT route, count(*) AS "values", CAST(sum(n) AS BIGINT) AS occurrences FROM v GROUP BY 1""",
    "place_orientations": f"""WITH v AS (SELECT DISTINCT c_custkey % 9 AS k, {_NATION} AS n, r_name AS r, lower({_PLACE}) AS norm FROM {_AT})
SELECT norm, 'first' AS orientation, lower(CASE k WHEN 0 THEN n ELSE r END) AS head, lower(CASE k WHEN 0 THEN r ELSE n END) AS context, CASE k WHEN 0 THEN r ELSE n END AS qualifier FROM v WHERE k < 2
UNION ALL SELECT norm, 'last', lower(CASE k WHEN 0 THEN r ELSE n END), lower(CASE k WHEN 0 THEN n ELSE r END), CASE k WHEN 0 THEN n ELSE r END FROM v WHERE k < 2
UNION ALL SELECT norm, 'paren', lower(n), lower(r), r FROM v WHERE k = 3 UNION ALL SELECT norm, 'malformed', NULL, NULL, NULL FROM v WHERE k IN (6, 7)""",
    "place_terms": f"""WITH n AS (SELECT n_nationkey AS subject, lower({_NATION}) AS name FROM nation)
SELECT name AS head, subject, false AS by_spelling, 2 AS rank, name AS term FROM n
UNION ALL SELECT concat('st ', name), subject, true, 1, concat('saint ', name) FROM n
UNION ALL SELECT concat('st. ', name), subject, subject % 2 = 1, CASE WHEN subject % 2 = 0 THEN 0 ELSE 1 END, concat(CASE WHEN subject % 2 = 0 THEN 'st. ' ELSE 'saint ' END, name) FROM n""",
    "number_year_slots": f"""WITH {_ORDERS} SELECT data_source, CASE WHEN k = 2 THEN 1 ELSE 0 END AS slot, count(*) AS n, count(*) AS four, count(*) AS fit FROM o WHERE k < 3 GROUP BY 1, 2""",
    "accession_years": f"""WITH {_ORDERS} SELECT record_id, CASE WHEN record_id % 3 > 0 THEN y ELSE y + 1 END AS year, CASE WHEN record_id % 3 > 0 THEN 'accession_date' ELSE 'acquisition_date' END AS year_source FROM o WHERE k < 2""",
    "number_years": f"""WITH {_ORDERS} SELECT record_id, data_source, year, value, recorded_diff, production_diff FROM d""",
    "scheme_verdicts": f"""WITH {_ORDERS}, c AS (SELECT data_source, round(avg(CASE WHEN k < 3 THEN 1.0 ELSE 0.0 END), 9) AS year_coverage FROM o GROUP BY 1),
a AS (SELECT data_source, count(recorded_diff) AS n_dated, count(production_diff) AS n_production, round(coalesce(avg(CAST(abs(recorded_diff) <= 1 AS INTEGER)), 0), 9) AS agree, round(coalesce(avg(CAST(recorded_diff < -1 AS INTEGER)), 0), 9) AS early,
  round(coalesce(avg(CAST(recorded_diff > 1 AS INTEGER)), 0), 9) AS late, round(coalesce(avg(CAST(production_diff < 0 AS INTEGER)), 0), 9) AS impossible, count(DISTINCT year) AS n_years FROM d GROUP BY 1),
t AS (SELECT data_source, year, max(tail) AS top FROM d GROUP BY 1, 2), l AS (SELECT data_source, top, lag(top) OVER (PARTITION BY data_source ORDER BY year) AS before FROM t),
r AS (SELECT data_source, round(avg(CAST(top < before AS INTEGER)), 9) AS restart_rate FROM l WHERE before IS NOT NULL GROUP BY 1)
SELECT c.*, n_dated, agree, early, late, n_production, impossible, n_years, restart_rate, CASE WHEN n_dated >= 30 THEN CASE WHEN agree >= 0.7 AND impossible <= 0.2 THEN 'confirmed' WHEN agree <= 0.3 OR impossible > 0.2 THEN 'rejected' ELSE 'plausible' END
  WHEN n_years >= 5 AND year_coverage >= 0.2 THEN 'plausible' ELSE 'rejected' END AS verdict, CASE WHEN n_dated >= 30 THEN 'dated records' ELSE 'structure' END AS evidence FROM c LEFT JOIN a USING (data_source) LEFT JOIN r USING (data_source)""",
    "completed_years": """WITH p AS (SELECT p_partkey, p_partkey % 100 AS d, 1900 + p_size * 2 AS top, p_size FROM part), y AS (SELECT p_partkey, max(c * 100 + d) AS year FROM p, range(15, 21) AS r(c) WHERE c * 100 + d <= top AND p_size > 3 GROUP BY 1)
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '1850' ELSE CAST(year AS VARCHAR) END AS year FROM p LEFT JOIN y USING (p_partkey)""",
    "pattern_head_floors": f"""WITH v AS (SELECT o_custkey % 12 AS data_source, regexp_replace(regexp_replace({_NUMBER}, '[A-Za-z]', 's', 'g'), '[0-9]', 'd', 'g') AS p FROM orders), c AS (SELECT data_source, p, count(*) AS n, sum(count(*)) OVER (PARTITION BY data_source) AS total FROM v GROUP BY 1, 2)
SELECT data_source, 'number' AS field_type, floor_ AS head_floor, CAST(sum(n) AS BIGINT) AS n_values, CAST(coalesce(sum(n) FILTER (n / total >= floor_), 0) AS BIGINT) AS head_count, count(*) FILTER (n / total >= floor_) AS n_head_patterns,
round(1 - coalesce(sum(n) FILTER (n / total >= floor_), 0) / sum(n), 9) AS divergent_share FROM c, (SELECT CAST(unnest([0.02, 0.05, 0.10]) AS DOUBLE) AS floor_) GROUP BY 1, 3""",
}
