"""Queries of the library's own operators, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics
from ..sources.nodes import PART_NODES_SQL, part_nodes

CORE, CATEGORICAL = ("p_name", "p_type"), ("p_name", "p_type")
CORE_SQL = "('p_name', 'p_type')"


def field_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.field_weights(part_nodes(spark, sf_dir), CORE).withColumn("w", F.round("w", 9))


def completeness_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.completeness(part_nodes(spark, sf_dir), CORE).withColumn("completeness", F.round("completeness", 9))


def value_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.value_frequencies(part_nodes(spark, sf_dir), CATEGORICAL)


def information_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.conformance_to_expectations(part_nodes(spark, sf_dir), CATEGORICAL).withColumn("information_content", F.round("information_content", 9))


QUERIES = {f.__name__: f for f in (field_weights, completeness_by_source, value_frequencies, information_content)}

_WEIGHTS = f"""{PART_NODES_SQL},
records AS (SELECT data_source, count(DISTINCT record_id) AS total FROM nodes GROUP BY 1),
described AS (SELECT * FROM nodes WHERE value IS NOT NULL AND field_type NOT IN {CORE_SQL}),
filled AS (SELECT field_type, data_source, count(DISTINCT record_id) AS n FROM described GROUP BY 1, 2),
grid AS (SELECT f.field_type, r.data_source, coalesce(n, 0) / total AS local
  FROM records r CROSS JOIN (SELECT DISTINCT field_type FROM described) f LEFT JOIN filled USING (field_type, data_source)),
both_fills AS (SELECT *, avg(local) OVER (PARTITION BY field_type) AS overall FROM grid),
weights AS (SELECT field_type, data_source, greatest(overall, local) AS w FROM both_fills WHERE overall > 0.1 OR local > 0.1)"""
_FREQUENCIES = f"""{PART_NODES_SQL},
own AS (SELECT * FROM nodes WHERE value IS NOT NULL AND field_type IN {CORE_SQL}),
counts AS (SELECT field_type, value, count(*) AS times FROM own GROUP BY 1, 2),
frequencies AS (SELECT *, CAST(sum(times) OVER (PARTITION BY field_type) AS BIGINT) AS n_f FROM counts)"""

ORACLE_SQL = {
    "field_weights": f"WITH {_WEIGHTS} SELECT field_type, data_source, round(w, 9) AS w FROM weights",
    "completeness_by_source": f"""WITH {_WEIGHTS},
total AS (SELECT data_source, sum(w) AS total FROM weights GROUP BY 1),
core AS (SELECT record_id, data_source FROM nodes WHERE value IS NOT NULL AND field_type IN {CORE_SQL} GROUP BY 1, 2 HAVING count(DISTINCT field_type) = 2),
got AS (SELECT record_id, data_source, sum(w) AS got FROM (SELECT DISTINCT record_id, data_source, field_type FROM described) JOIN weights USING (field_type, data_source) GROUP BY 1, 2)
SELECT record_id, data_source, round(coalesce(got, 0) / total, 9) AS completeness FROM core LEFT JOIN got USING (record_id, data_source) LEFT JOIN total USING (data_source)""",
    "value_frequencies": f"WITH {_FREQUENCIES} SELECT field_type, value, times, n_f FROM frequencies",
    "information_content": f"""WITH {_FREQUENCIES},
ic AS (SELECT field_type, value, least(greatest(CASE WHEN n_f > 1 THEN 1 - ln(times) / ln(n_f) END, 0), 1) AS ic FROM frequencies)
SELECT record_id, data_source, round(avg(ic), 9) AS information_content, count(*) AS n_values FROM own LEFT JOIN ic USING (field_type, value) GROUP BY 1, 2""",
}
