"""Queries of the profile and rank operators, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsers
from ..functions import text as T
from ..operators import metrics, profiles, ranked
from ..sources.nodes import CONVERSATION_TEXTS_SQL, DOCUMENT_NODES_SQL, LINE_NODES_SQL, ORDER_TREE_SQL, PART_NODES_SQL, conversation_texts, document_nodes, line_nodes, order_tree, part_nodes
from ..streaming import events

FIELDS = ("p_name", "p_type", "p_size", "p_retailprice")


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to nine places, as sums differ in their last bits by the order of rows."""
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importance_weights(spark, sf_dir):
    return rounded(profiles.importance_weights(part_nodes(spark, sf_dir)))


def completeness_ratios(spark, sf_dir):
    return rounded(profiles.completeness_ratios(part_nodes(spark, sf_dir), FIELDS))


def provenance(spark, sf_dir):
    nodes = part_nodes(spark, sf_dir)
    return rounded(profiles.provenance(metrics.completeness(nodes, ("p_name", "p_type")), "completeness"))


def field_frequency_profile(spark, sf_dir):
    return rounded(profiles.field_frequency_profile(part_nodes(spark, sf_dir)))


def pareto_summary(spark, sf_dir):
    return rounded(profiles.pareto_summary(profiles.field_frequency_profile(part_nodes(spark, sf_dir))))


def field_vocabulary(spark, sf_dir):
    return rounded(profiles.field_vocabulary(part_nodes(spark, sf_dir), FIELDS))


def fragmentation(spark, sf_dir):
    return rounded(profiles.fragmentation(part_nodes(spark, sf_dir), FIELDS))


def term_weights(spark, sf_dir):
    return rounded(profiles.term_weights(document_nodes(spark, sf_dir).where("field_type = 'text'"), ["record_id", "field_type"]))


def text_coherence(spark, sf_dir):
    return rounded(profiles.coherence(conversation_texts(spark, sf_dir)))


def thinness(spark, sf_dir):
    return rounded(profiles.thinness(document_nodes(spark, sf_dir), ["text"]))


def decomposition_cells(spark, sf_dir):
    return rounded(profiles.decomposition_cells(order_tree(spark, sf_dir)))


def decomposition(spark, sf_dir):
    return rounded(profiles.decomposition(order_tree(spark, sf_dir)))


def pattern_counts(spark, sf_dir):
    return profiles.pattern_counts(part_nodes(spark, sf_dir))


def pattern_widths(spark, sf_dir):
    return profiles.pattern_widths(part_nodes(spark, sf_dir))


def pattern_concentration(spark, sf_dir):
    return rounded(profiles.pattern_concentration(part_nodes(spark, sf_dir)))


def pattern_consistency(spark, sf_dir):
    return rounded(profiles.pattern_consistency(part_nodes(spark, sf_dir)))


def consensus_home(spark, sf_dir):
    return profiles.consensus_home(line_nodes(spark, sf_dir))


def conflation(spark, sf_dir):
    return rounded(profiles.conflation(line_nodes(spark, sf_dir)))


def source_divergence(spark, sf_dir):
    return rounded(profiles.divergence(part_nodes(spark, sf_dir), "p_type"))


def variance_share(spark, sf_dir):
    return profiles.variance_share(_table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice").withColumn("share", F.round("share", 9))


def normalised_terms(spark, sf_dir):
    text = F.col("text")
    return _table(spark, sf_dir, "benchmark").select("item_id", T.norm_term(text).alias("norm"), T.fold(text).alias("folded"))


def best_proposals(spark, sf_dir):
    order = [F.col("l_linenumber"), -F.col("l_discount"), F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_quantity"), F.col("l_extendedprice")]
    return ranked.winners(_table(spark, sf_dir, "lineitem"), ["l_partkey"], order, ["l_orderkey", "l_linenumber", "l_discount"])


def _above(spark, sf_dir) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    up = _table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("child"), F.concat(F.lit("n"), "c_nationkey").alias("parent"))
    return up.unionByName(nation.select(F.concat(F.lit("n"), "n_nationkey").alias("child"), F.concat(F.lit("r"), "n_regionkey").alias("parent")))


def ancestors(spark, sf_dir):
    return ranked.hops(_above(spark, sf_dir), "child", "parent", 3)


def all_ancestors(spark, sf_dir):
    return ranked.closure(_above(spark, sf_dir), "child", "parent")


def order_islands(spark, sf_dir):
    days = _table(spark, sf_dir, "orders").select("o_custkey", F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).alias("day"))
    return ranked.islands(days, ["o_custkey"], "day", 60)


def false_discovery(spark, sf_dir):
    tests = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.round(F.abs("c_acctbal") / 10000, 3).alias("p"))
    return rounded(ranked.false_discovery(tests, ["c_mktsegment"], "p"))


def threshold_sweep(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    both = docs.join(labels, "doc_id").withColumn("score", F.floor(F.col("n_chars") / 100))
    return rounded(ranked.threshold_sweep(both.withColumn("grp", F.lit("all")), ["grp"], "score", "quality").drop("grp"))


def link_census(spark, sf_dir):
    """Orders by priority and status: how many, with how many customers, and the 9th tenth of their prices."""
    orders = _table(spark, sf_dir, "orders").withColumn("price", F.floor("o_totalprice").cast("long"))
    keys = ["o_orderpriority", "o_orderstatus"]
    counts = orders.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"))
    return counts.join(ranked.nearest_quantile(orders, keys, "price", 9, "q90"), keys)


def parsed_prices(spark, sf_dir):
    """Prices written in seven ways, read back."""
    lines = _table(spark, sf_dir, "lineitem").select(F.expr(f"{_PRICE} AS raw")).groupBy("raw").agg(F.count("*").alias("n"))
    return lines.withColumn("m", parsers.money(F.col("raw"))).select("raw", "n", "m.currency_system", "m.normalised_pence")


def parsed_counts(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select(F.expr(f"{_COUNT} AS raw")).groupBy("raw").agg(F.count("*").alias("n"))
    parts = lines.withColumn("c", parsers.counts(F.col("raw")))
    return parts.select("raw", "n", F.size("c").alias("parts"), F.col("c")[0]["count"].alias("first"), F.col("c")[1]["range_hi"].alias("second_hi"), F.col("c")[1]["noun"].alias("noun"))


def event_windows(spark, sf_dir):
    counts = events.windowed_counts(_table(spark, sf_dir, "events"))
    return counts.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 6).alias("total"))


# These two expressions run in both dialects.
_Q = "CAST(CAST(l_quantity AS INT) AS VARCHAR(9))"
_N = "CAST(l_linenumber AS VARCHAR(9))"
_PRICE = f"""CASE l_linenumber WHEN 1 THEN concat('£', {_Q}, '.50') WHEN 2 THEN concat({_Q}, ' guineas') WHEN 3 THEN concat('£', {_Q}, '/10/-')
  WHEN 4 THEN concat('[', {_Q}, '/6]') WHEN 5 THEN concat({_Q}, 's 6d for set') WHEN 6 THEN concat({_Q}, ' pounds') ELSE concat({_Q}, '/- and 3/6 for 7') END"""
_COUNT = f"concat({_Q}, ' + ', {_N}, '-', {_Q}, ' fragments')"

QUERIES = {
    f.__name__: f
    for f in (
        importance_weights, completeness_ratios, provenance, field_frequency_profile, pareto_summary, field_vocabulary, fragmentation, term_weights,
        text_coherence, thinness, decomposition_cells, decomposition, pattern_counts, pattern_widths, pattern_concentration, pattern_consistency,
        consensus_home, conflation, source_divergence, variance_share, normalised_terms, best_proposals, ancestors, all_ancestors, order_islands, false_discovery,
        threshold_sweep, link_census, parsed_prices, parsed_counts, event_windows,
    )
}

_FILL = f"""{PART_NODES_SQL},
present AS (SELECT * FROM nodes WHERE value IS NOT NULL),
totals AS (SELECT data_source, count(DISTINCT record_id) AS total FROM nodes GROUP BY 1),
filled AS (SELECT field_type, data_source, count(DISTINCT record_id) AS n FROM present GROUP BY 1, 2),
weights AS (SELECT field_type, avg(coalesce(n, 0) / total) AS w
  FROM totals CROSS JOIN (SELECT DISTINCT field_type FROM present) LEFT JOIN filled USING (field_type, data_source) GROUP BY 1)"""
_PROFILE = f"""{PART_NODES_SQL},
counts AS (SELECT data_source, field_type, count(*) AS occurrences FROM nodes WHERE value IS NOT NULL GROUP BY 1, 2),
profile AS (SELECT *, occurrences / sum(occurrences) OVER (PARTITION BY data_source) AS share,
  sum(occurrences) OVER (PARTITION BY data_source ORDER BY occurrences DESC, field_type ROWS UNBOUNDED PRECEDING) / sum(occurrences) OVER (PARTITION BY data_source) AS cum_share,
  row_number() OVER (PARTITION BY data_source ORDER BY occurrences DESC, field_type) AS rank, count(*) OVER (PARTITION BY data_source) AS n FROM counts)"""
_WORD = T.WORD
_NORM = r"trim(regexp_replace(lower({}), '\s+', ' ', 'g'), ' .,;:')"
_RUNS = r"regexp_extract_all(regexp_replace(regexp_replace(value, '[A-Za-z]', 's', 'g'), '[0-9]', 'd', 'g'), 'd+|s+|[\s\S]')"
_PATTERNS = f"""{PART_NODES_SQL},
present AS (SELECT *, {_RUNS} AS runs FROM nodes WHERE value IS NOT NULL),
signed AS (SELECT *, array_to_string(list_transform(runs, lambda r: CASE WHEN length(r) > 1 THEN r[1] || '{{' || length(r) || '}}' ELSE r END), '') AS pattern,
  array_to_string(list_transform(runs, lambda r: r[1]), '') AS skeleton FROM present),
counts AS (SELECT data_source, field_type, pattern, count(*) AS n FROM signed GROUP BY 1, 2, 3),
shares AS (SELECT *, n / sum(n) OVER (PARTITION BY data_source, field_type) >= 0.05 AS head,
  sum(n) OVER (PARTITION BY data_source, field_type ORDER BY n DESC, pattern ROWS UNBOUNDED PRECEDING) AS cum, sum(n) OVER (PARTITION BY data_source, field_type) AS total FROM counts)"""
_FRAGMENTS = f"""{ORDER_TREE_SQL},
roots AS (SELECT *, CAST(node_id IN (SELECT parent_id FROM tree WHERE depth = 1) AS INT) AS decomposed FROM tree WHERE depth = 0),
fragments AS (SELECT * FROM roots WHERE value IS NOT NULL OR decomposed = 1)"""
_TERMS = f"{LINE_NODES_SQL}, usage AS (SELECT DISTINCT data_source, field_type, {_NORM.format('value')} AS norm FROM nodes WHERE value IS NOT NULL)"

ORACLE_SQL = {
    "importance_weights": f"WITH {_FILL} SELECT field_type, round(w, 9) AS w FROM weights",
    "completeness_ratios": f"""WITH {_FILL} SELECT record_id, data_source, round(count(*) / 4, 9) AS ratio, round(sum(w) / (SELECT sum(w) FROM weights), 9) AS weighted
FROM (SELECT DISTINCT record_id, data_source, field_type FROM present) JOIN weights USING (field_type) GROUP BY 1, 2""",
    "field_frequency_profile": f"WITH {_PROFILE} SELECT data_source, field_type, occurrences, round(share, 9) AS share, round(cum_share, 9) AS cum_share, CAST(rank AS INT) AS rank FROM profile",
    "pareto_summary": f"""WITH {_PROFILE} SELECT data_source, count(*) AS n_fields, least(count(*) FILTER (cum_share < 0.5) + 1, count(*)) AS k_50,
  least(count(*) FILTER (cum_share < 0.8) + 1, count(*)) AS k_80, round(sum(share) FILTER (rank <= ceil(n / 5)), 9) AS top_fifth_share FROM profile GROUP BY 1""",
    "field_vocabulary": f"""WITH {PART_NODES_SQL},
counts AS (SELECT field_type, value, count(*) AS times FROM nodes WHERE value IS NOT NULL GROUP BY 1, 2),
f AS (SELECT *, sum(times) OVER (PARTITION BY field_type) AS n_f, sum(times) OVER (PARTITION BY field_type ORDER BY times DESC, value ROWS UNBOUNDED PRECEDING) AS cum FROM counts),
i AS (SELECT *, least(greatest(CASE WHEN n_f > 1 THEN 1 - ln(times) / ln(n_f) END, 0), 1) AS ic FROM f)
SELECT field_type, CAST(sum(times) AS BIGINT) AS n_occurrences, count(*) AS n_distinct, round(avg(CAST(times = 1 AS INT)), 9) AS singleton_rate, round(avg(ic), 9) AS mean_ic,
  round(sum(ic * times) / sum(times), 9) AS mean_ic_weighted, least(count(*) FILTER (10 * cum < 8 * n_f) + 1, count(*)) AS k_80 FROM i GROUP BY 1""",
    "fragmentation": f"""WITH {PART_NODES_SQL},
counts AS (SELECT data_source, field_type, {_NORM.format('value')} AS norm, count(*) AS occ FROM nodes WHERE value IS NOT NULL GROUP BY 1, 2, 3),
f AS (SELECT *, sum(occ) OVER (PARTITION BY data_source, field_type) AS total, sum(occ) OVER (PARTITION BY data_source, field_type ORDER BY occ DESC, norm ROWS UNBOUNDED PRECEDING) AS cum FROM counts)
SELECT data_source, field_type, count(*) AS n_terms, CAST(sum(occ) AS BIGINT) AS n_occurrences, round(avg(CAST(occ = 1 AS INT)), 9) AS singleton_rate,
  least(count(*) FILTER (10 * cum < 8 * total) + 1, count(*)) AS k_80, round(CASE WHEN sum(occ) > 1 THEN ln(count(*)) / ln(sum(occ)) END, 9) AS fragmentation FROM f GROUP BY 1, 2""",
    "term_weights": f"""WITH tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_WORD}')) AS token FROM documents),
df AS (SELECT token, count(DISTINCT doc_id) AS df, count(*) AS total FROM tokens GROUP BY 1 HAVING df >= 3 ORDER BY total DESC, token LIMIT 50000)
SELECT token, df, total, round(ln((1 + (SELECT count(DISTINCT doc_id) FROM documents WHERE length(text) > 0)) / (1 + df)) + 1, 9) AS idf FROM df""",
    "text_coherence": f"""WITH {CONVERSATION_TEXTS_SQL},
docs AS (SELECT DISTINCT record_id, field_type FROM texts WHERE length(value) > 0),
several AS (SELECT record_id, count(*) AS n_docs FROM docs GROUP BY 1 HAVING count(*) >= 2),
tokens AS (SELECT record_id, field_type, unnest(regexp_extract_all(lower(value), '{_WORD}')) AS token FROM texts WHERE length(value) > 0),
tf AS (SELECT record_id, field_type, token, count(*) AS tf FROM tokens GROUP BY 1, 2, 3),
idf AS (SELECT token, ln((1 + (SELECT count(*) FROM docs)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 3 ORDER BY sum(tf) DESC, token LIMIT 50000),
w AS (SELECT record_id, field_type, token, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (token) SEMI JOIN several USING (record_id)),
u AS (SELECT record_id, field_type, token, w / sqrt(sum(w * w) OVER (PARTITION BY record_id, field_type)) AS w FROM w),
sims AS (SELECT a.record_id, sum(a.w * b.w) AS s FROM u a JOIN u b ON a.record_id = b.record_id AND a.token = b.token AND a.field_type < b.field_type GROUP BY 1)
SELECT record_id, n_docs, round(least(greatest(1 - coalesce(s, 0) / (n_docs * (n_docs - 1) / 2), 0), 1), 9) AS coherence FROM several LEFT JOIN sims USING (record_id)""",
    "thinness": f"""WITH {DOCUMENT_NODES_SQL},
chars AS (SELECT record_id, data_source, CAST(sum(coalesce(length(value), 0)) AS BIGINT) AS c_total, sum(CASE WHEN field_type = 'text' THEN coalesce(length(value), 0) ELSE 0 END) AS c_free FROM nodes GROUP BY 1, 2),
sorted AS (SELECT data_source, list(c_total ORDER BY c_total) AS l FROM chars GROUP BY 1),
q AS (SELECT *, l[(9 * (len(l) - 1) + 5) // 10 + 1] AS q90 FROM chars JOIN sorted USING (data_source)),
d AS (SELECT record_id, data_source, c_total, CASE WHEN q90 > 0 THEN least(c_total / q90, 1) END AS density, CASE WHEN c_total >= 50 THEN c_free / c_total END AS skew FROM q)
SELECT record_id, data_source, c_total, round(density, 9) AS density, round(skew, 9) AS skew, round(1 - density * (1 - coalesce(skew, 0)), 9) AS thinness FROM d""",
    "decomposition_cells": f"WITH {_FRAGMENTS} SELECT data_source, field_type, count(*) AS fragments, round(avg(decomposed), 9) AS decomposed FROM fragments GROUP BY 1, 2",
    "decomposition": f"""WITH {_FRAGMENTS},
p AS (SELECT field_type, avg(decomposed) AS p FROM fragments GROUP BY 1),
rate AS (SELECT record_id, data_source, CASE WHEN sum(p) > 0 THEN sum(p * decomposed) / sum(p) END AS rate FROM fragments JOIN p USING (field_type) GROUP BY 1, 2),
depth AS (SELECT record_id, data_source, count(*) / count(DISTINCT parent_id) AS depth FROM tree WHERE depth = 1 GROUP BY 1, 2)
SELECT record_id, data_source, round(rate, 9) AS decomposition_rate, round(depth, 9) AS decomposition_depth FROM rate LEFT JOIN depth USING (record_id, data_source)""",
    "pattern_counts": f"WITH {_PATTERNS} SELECT data_source, field_type, pattern, n FROM counts",
    "pattern_widths": f"""WITH {_PATTERNS},
r AS (SELECT field_type, skeleton, unnest(range(len(runs))) AS run, runs FROM signed)
SELECT field_type, skeleton, CAST(run AS INT) AS run, count(*) AS n, CAST(min(length(runs[run + 1])) AS INT) AS shortest, CAST(max(length(runs[run + 1])) AS INT) AS longest FROM r GROUP BY 1, 2, 3""",
    "pattern_concentration": f"""WITH {_PATTERNS} SELECT data_source, field_type, count(*) AS n_patterns, count(*) FILTER (head) AS n_head_patterns, CAST(sum(n) AS BIGINT) AS n_records,
  round(coalesce(sum(n) FILTER (head), 0) / sum(n), 9) AS head_share, least(count(*) FILTER (10 * cum < 8 * total) + 1, count(*)) AS k_80 FROM shares GROUP BY 1, 2""",
    "pattern_consistency": f"""WITH {_PATTERNS} SELECT record_id, data_source, count(*) AS applicable, count(*) FILTER (head) AS conventional, round(count(*) FILTER (head) / count(*), 9) AS consistency
FROM signed JOIN shares USING (data_source, field_type, pattern) GROUP BY 1, 2""",
    "consensus_home": f"""WITH {_TERMS},
support AS (SELECT *, count(*) OVER (PARTITION BY norm) AS homes FROM (SELECT norm, field_type AS field, count(*) AS sources FROM usage GROUP BY 1, 2)),
others AS (SELECT data_source, norm, field_type, field, sources - CAST(field = field_type AS INT) AS sources FROM usage JOIN support USING (norm) WHERE homes > 1),
best AS (SELECT *, row_number() OVER (PARTITION BY data_source, norm, field_type ORDER BY sources DESC, field) AS r, sum(sources) OVER (PARTITION BY data_source, norm, field_type) AS every FROM others)
SELECT data_source, norm, field_type, field AS home_field, sources AS home_sources, CAST(every AS BIGINT) AS all_sources FROM best WHERE r = 1 AND field <> field_type AND sources >= 2 AND sources / every >= 0.5""",
    "conflation": f"""WITH {_TERMS}, sizes AS (SELECT data_source, field_type, count(*) AS n FROM usage GROUP BY 1, 2)
SELECT a.data_source, a.field_type AS field_a, b.field_type AS field_b, count(*) AS shared, any_value(x.n) AS n_a, any_value(y.n) AS n_b, round(count(*) / least(any_value(x.n), any_value(y.n)), 9) AS overlap
FROM usage a JOIN usage b ON a.data_source = b.data_source AND a.norm = b.norm AND a.field_type < b.field_type
JOIN sizes x ON x.data_source = a.data_source AND x.field_type = a.field_type JOIN sizes y ON y.data_source = a.data_source AND y.field_type = b.field_type GROUP BY 1, 2, 3""",
    "source_divergence": f"""WITH {PART_NODES_SQL},
shares AS (SELECT data_source, value, count(*) / sum(count(*)) OVER (PARTITION BY data_source) AS p FROM nodes WHERE field_type = 'p_type' AND value IS NOT NULL GROUP BY 1, 2),
grid AS (SELECT a.data_source AS source_a, b.data_source AS source_b, v.value FROM (SELECT DISTINCT data_source FROM shares) a JOIN (SELECT DISTINCT data_source FROM shares) b ON a.data_source < b.data_source CROSS JOIN (SELECT DISTINCT value FROM shares) v),
both_p AS (SELECT source_a, source_b, coalesce(x.p, 0) AS p, coalesce(y.p, 0) AS q FROM grid g LEFT JOIN shares x ON x.data_source = source_a AND x.value = g.value LEFT JOIN shares y ON y.data_source = source_b AND y.value = g.value)
SELECT source_a, source_b, round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)), 9) AS distance
FROM both_p GROUP BY 1, 2 HAVING sum(CASE WHEN p > 0 AND q > 0 THEN 1 ELSE 0 END) > 0""",
    "variance_share": """WITH m AS (SELECT avg(o_totalprice) AS grand FROM orders), g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS mean FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1)
SELECT count(*) AS groups, round(sum(n * (mean - grand) * (mean - grand)) / (SELECT sum((o_totalprice - grand) * (o_totalprice - grand)) FROM orders, m), 9) AS share FROM g, m""",
    "normalised_terms": f"SELECT item_id, {_NORM.format('text')} AS norm, trim(regexp_replace(lower(text), '[^0-9a-z]+', ' ', 'g')) AS folded FROM benchmark",
    "best_proposals": """SELECT l_partkey, l_orderkey, l_linenumber, l_discount FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_discount DESC, l_orderkey, l_suppkey, l_quantity, l_extendedprice) = 1""",
    "ancestors": """WITH RECURSIVE edges AS (SELECT 'c' || c_custkey AS child, 'n' || c_nationkey AS parent FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
up AS (SELECT child AS subject, parent AS ancestor, 1 AS steps FROM edges UNION SELECT subject, parent, steps + 1 FROM up JOIN edges ON ancestor = child)
SELECT subject, ancestor, min(steps) AS steps FROM up GROUP BY 1, 2""",
    "order_islands": """WITH p AS (SELECT o_custkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT) AS day, count(*) AS n FROM orders GROUP BY 1, 2),
b AS (SELECT *, coalesce(CAST(day - lag(day) OVER (PARTITION BY o_custkey ORDER BY day) > 60 AS INT), 0) AS new FROM p),
i AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY day) AS island FROM b)
SELECT o_custkey, CAST(island AS BIGINT) AS island, min(day) AS first, max(day) AS last, CAST(sum(n) AS BIGINT) AS n FROM i GROUP BY 1, 2""",
    "false_discovery": """WITH t AS (SELECT c_custkey, c_mktsegment, round(abs(c_acctbal) / 10000, 3) AS p FROM customer),
r AS (SELECT *, p * count(*) OVER (PARTITION BY c_mktsegment) / row_number() OVER (PARTITION BY c_mktsegment ORDER BY p, c_custkey) AS raw FROM t)
SELECT c_custkey, c_mktsegment, round(p, 9) AS p, round(least(min(raw) OVER (PARTITION BY c_mktsegment ORDER BY p DESC RANGE UNBOUNDED PRECEDING), 1), 9) AS q FROM r""",
    "threshold_sweep": """WITH s AS (SELECT n_chars // 100 AS score, quality FROM documents JOIN labels USING (doc_id)),
g AS (SELECT DISTINCT score FROM s), w AS (SELECT g.score, count(*) AS n, CAST(sum(quality) AS BIGINT) AS hits FROM g JOIN s ON s.score >= g.score GROUP BY 1)
SELECT score, n, hits, round(hits / n, 9) AS precision,
  round((hits / n + 3.8416 / (2 * n) - 1.96 * sqrt((hits / n * (1 - hits / n) + 3.8416 / (4 * n)) / n)) / (1 + 3.8416 / n), 9) AS low FROM w""",
    "link_census": """WITH s AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers, list(CAST(floor(o_totalprice) AS BIGINT) ORDER BY floor(o_totalprice)) AS l FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, o_orderstatus, n, customers, l[(9 * (len(l) - 1) + 5) // 10 + 1] AS q90 FROM s""",
}
ORACLE_SQL["parsed_prices"] = f"""WITH l AS (SELECT l_linenumber AS k, CAST(l_quantity AS INT) AS q, {_PRICE} AS raw FROM lineitem)
SELECT raw, count(*) AS n, any_value(CASE WHEN k IN (1, 6) THEN 'gbp_decimal' WHEN k = 2 THEN 'gbp_guinea' WHEN k IN (3, 4, 5) THEN 'gbp_lsd' END) AS currency_system,
  any_value(CAST(CASE k WHEN 1 THEN 100 * q + 50 WHEN 2 THEN 252 * q WHEN 3 THEN 240 * q + 120 WHEN 4 THEN 12 * q + 6 WHEN 5 THEN 12 * q + 6 WHEN 6 THEN 100 * q END AS BIGINT)) AS normalised_pence FROM l GROUP BY raw"""
ORACLE_SQL["parsed_counts"] = f"""WITH l AS (SELECT l_linenumber AS k, CAST(l_quantity AS BIGINT) AS q, {_COUNT} AS raw FROM lineitem)
SELECT raw, count(*) AS n, any_value(CASE WHEN k <= q THEN 2 END) AS parts, any_value(CASE WHEN k <= q THEN q END) AS "first", any_value(CASE WHEN k <= q THEN q END) AS second_hi,
  any_value(CASE WHEN k <= q THEN 'fragments' END) AS noun FROM l GROUP BY raw"""
ORACLE_SQL["event_windows"] = """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2"""


def _provenance_sql() -> str:
    from .queries import ORACLE_SQL as own

    exact = own["completeness_by_source"].replace("round(coalesce(got, 0) / total, 9)", "coalesce(got, 0) / total")
    return f"SELECT data_source, round(avg(completeness), 9) AS provenance, count(*) AS n_records FROM ({exact}) GROUP BY 1"


ORACLE_SQL["provenance"] = _provenance_sql()
ORACLE_SQL["all_ancestors"] = ORACLE_SQL["ancestors"]
