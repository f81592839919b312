"""Queries of the compile, alignment and statistics operators, and the same in SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..functions import dates as dated
from ..functions import text as T
from ..operators import alignment, compile, statistics
from ..sources.dealt import dealt
from ..sources.nodes import ORDER_TREE_SQL, PART_NODES_SQL, order_tree, part_nodes
from .profile_queries import rounded


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_pages(spark, sf_dir):
    text = clean.plain(F.col("html"))
    return _table(spark, sf_dir, "pages").select("page_id", F.md5(text.cast("binary")).alias("digest"), F.length(text).alias("n_chars"))


# In both dialects: values with a question mark as a link, in prose, within a value, at an edge, and without one.
_ASKED = """CASE p_partkey % 8 WHEN 0 THEN concat('see www.example.org/?id=', CAST(p_size AS VARCHAR(9))) WHEN 1 THEN concat('was the ', p_name, ' made of it or of ', p_type, '?') WHEN 2 THEN concat(p_name, ' ? ', p_type)
WHEN 3 THEN concat(p_name, '??') WHEN 4 THEN concat('? ', p_name) WHEN 5 THEN concat('the of ', p_brand, '?') WHEN 6 THEN concat(CAST(p_size AS VARCHAR(9)), '?') ELSE p_name END"""
_JOINING = ("was", "the", "of", "it", "or", "and", "is")


def question_uses(spark, sf_dir):
    text = F.expr(_ASKED)
    rows = _table(spark, sf_dir, "part").select(F.col("p_brand").alias("data_source"), clean.question_use(text, _JOINING).alias("use"), F.floor(clean.join_share(text, _JOINING) * 40).cast("int").alias("bin"))
    return rows.groupBy("data_source", "use", "bin").agg(F.count("*").alias("n"))


def _orders_base(spark, sf_dir) -> DataFrame:
    """Orders as nodes of their priority's field."""
    found = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("node_id"), F.col("o_custkey").alias("record_id"), F.substring("o_orderpriority", 1, 1).alias("data_source"),
        F.col("o_orderpriority").alias("field_type"), F.col("o_orderstatus").alias("value"), F.col("o_orderstatus").alias("base_value"),
    )
    return dealt(found, "node_id", 100_000)


def _line_proposals(spark, sf_dir) -> DataFrame:
    """Order lines as proposals about their orders."""
    found = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("node_id"), F.expr("CASE WHEN l_linenumber = 3 THEN 'X' WHEN l_linenumber = 2 THEN 'O' END").alias("expect_value"),
        F.col("l_returnflag").alias("new_value"), F.expr("concat('c', l_partkey % 3)").alias("component"), F.expr("CAST(l_linenumber % 2 AS INT)").alias("tier"),
        F.expr("CASE WHEN l_linenumber % 4 <> 0 THEN l_discount END").alias("confidence"),
    )
    return dealt(found, "node_id", 400_000)


PROTECTED = ("1-URGENT",)


def merged_proposals(spark, sf_dir):
    return compile.merge(_orders_base(spark, sf_dir), _line_proposals(spark, sf_dir), PROTECTED)


def _compiled(spark, sf_dir) -> DataFrame:
    base = _orders_base(spark, sf_dir)
    flags = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("node_id"), F.expr("CASE l_suppkey % 10 WHEN 0 THEN 'qualified' WHEN 1 THEN 'deferred' WHEN 2 THEN 'enriched' WHEN 3 THEN 'verified' END").alias("flag")).where("flag IS NOT NULL")
    return compile.dispositions(base, compile.merge(base, _line_proposals(spark, sf_dir), PROTECTED), flags)


def disposition_census(spark, sf_dir):
    return compile.census(_compiled(spark, sf_dir))


def post_conditions(spark, sf_dir):
    return compile.post_conditions(_orders_base(spark, sf_dir), _compiled(spark, sf_dir), PROTECTED)


def base_values(spark, sf_dir):
    """Nodes of parts, with names given as placeholders, echoes or with dangling separators in turn."""
    nodes = part_nodes(spark, sf_dir).withColumn("value", F.expr(_DIRTY))
    fixes = _table(spark, sf_dir, "part").select(F.lit("p_type").alias("field_type"), F.col("p_type").alias("value"), F.lower("p_type").alias("fixed")).distinct()
    return compile.base_table(nodes, fixes, protected=("p_size",), verbatim=("p_retailprice",)).select("record_id", "field_type", "base_value")


def inlined_groups(spark, sf_dir):
    own = dealt(_table(spark, sf_dir, "customer"), "c_custkey").select(F.col("c_custkey").alias("record_id"), F.concat(F.lit("n"), F.col("c_custkey")).alias("node_id"), "c_mktsegment", "c_acctbal")
    made = compile.inline_groups(own, "doubt", {"note": F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")), "debt": F.when(F.col("c_acctbal") < 0, F.lit("yes"))})
    return made.groupBy("depth", "field_type", "value").agg(F.count("*").alias("n"), F.countDistinct("node_id").alias("ids"), F.countDistinct("parent_id").alias("parents"))


def transferred(spark, sf_dir):
    return compile.transfer(part_nodes(spark, sf_dir), "p_size", ("p_retailprice",))


def unanimous_flags(spark, sf_dir):
    return compile.unanimous(_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linestatus")


def repeated_statements(spark, sf_dir):
    return compile.repeated_statements(order_tree(spark, sf_dir))


def reused_titles(spark, sf_dir):
    return compile.reused_titles(part_nodes(spark, sf_dir), "p_name", most=3)


def check_failures(spark, sf_dir):
    parts = _table(spark, sf_dir, "part")
    checks = {"cheap": (F.col("p_size") > 10, F.col("p_retailprice") < 1500), "named": (F.lit(True), F.col("p_name").rlike("^[a-z ]+$"))}
    return compile.failures(parts, checks)


def _index(spark, sf_dir) -> DataFrame:
    """Parts as subjects of terms made of their names; how often they are ordered as prominence."""
    parts = _table(spark, sf_dir, "part")
    uses = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum(F.when(F.col("l_quantity") > 45, 40).otherwise(1)).alias("prominence"))
    return parts.join(uses, "p_partkey", "left").select(T.norm_term(F.expr("concat(p_name, CASE WHEN p_partkey % 5 < 3 THEN concat(' ', p_partkey % 40) ELSE '' END)")).alias("norm"), F.col("p_partkey").alias("subject"), F.col("p_brand").alias("kind"), F.coalesce("prominence", F.lit(0)).alias("prominence"))


def resolved_terms(spark, sf_dir):
    return alignment.resolve_homographs(_index(spark, sf_dir), ("Brand#11", "Brand#22", "Brand#33"))


def cascaded_terms(spark, sf_dir):
    values = _table(spark, sf_dir, "part").select(F.expr(_SPELT).alias("value"))
    return alignment.cascade(values, "value", _table(spark, sf_dir, "part").select(T.norm_term(F.col("p_name")).alias("norm")))


def overlaid_terms(spark, sf_dir):
    pooled = _table(spark, sf_dir, "part").select(F.col("p_brand").alias("data_source"), F.col("p_type").alias("norm"), F.lit("pool").alias("subject")).distinct()
    return alignment.overlay(pooled, pooled.where("data_source < 'Brand#3'").withColumn("subject", F.when(F.col("norm") < "P", "own").otherwise("pool")))


def fuzzy_terms(spark, sf_dir):
    """Words of the documents that are near, but seldom equal, to words of the benchmark."""
    words = lambda name: _table(spark, sf_dir, name).select(F.explode(F.split(T.fold(F.col("text")), " ")).alias("norm"))
    return rounded(alignment.fuzzy_join(words("documents"), words("benchmark")))


def overlapping_spans(spark, sf_dir):
    days = _table(spark, sf_dir, "orders").select(F.col("o_orderkey"), F.datediff(F.col("o_orderdate"), F.to_date(F.lit("1990-01-01"))).alias("lo"))
    spans = days.select(F.col("o_orderkey").alias("span_id"), "lo", (F.col("lo") + F.col("o_orderkey") % 30).cast("int").alias("hi"))
    parts = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("query_id"), (1900 + F.col("s_suppkey") * 7).cast("int").alias("lo"), (1900 + F.col("s_suppkey") * 8).cast("int").alias("hi"))
    return alignment.overlap_totals(parts, spans)


def prefix_matches(spark, sf_dir):
    tokens = lambda text: F.filter(F.split(T.fold(text), " "), lambda t: F.length(t) >= 3)
    asked = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), tokens(F.col("text")).alias("tokens"))
    return alignment.prefix_matches(asked, _table(spark, sf_dir, "documents").select("doc_id", tokens(F.col("text")).alias("tokens")))


def coverage_queue(spark, sf_dir):
    values = _table(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(F.count("*").alias("n"))
    return alignment.coverage_queue(values, "p_brand", "n", "p_name", 0.9)


def balance_histogram(spark, sf_dir):
    return statistics.histogram(_table(spark, sf_dir, "customer"), "c_acctbal", 0.0, 8192.0, 16)


def measure_spread(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("x"))
    return rounded(statistics.spread(rows, ["l_returnflag"], "x", 0, 64, 8))


def chi_square(spark, sf_dir):
    return rounded(statistics.chi_square(_table(spark, sf_dir, "part"), ["p_brand"], "p_type", "p_name"))


def kolmogorov_smirnov(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select("l_linenumber", F.col("l_quantity").alias("x"), (F.col("l_linestatus") == "O").alias("second"))
    return rounded(statistics.kolmogorov_smirnov(rows, ["l_linenumber"], "second", "x"))


def spearman(spark, sf_dir):
    return rounded(statistics.spearman(_table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_discount"))


def agreement(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem")
    rows = lambda where: lines.where(where).select("l_returnflag", "l_orderkey", "l_linenumber")
    return rounded(statistics.agreement(rows("l_quantity > 20"), rows("l_discount > 0.04"), ["l_orderkey", "l_linenumber"], ["l_returnflag"]))


def paired_change(spark, sf_dir):
    rows = lambda keep: _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.expr(keep).alias("x"))
    return rounded(statistics.paired_change(rows("CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END"), rows("CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal * 2 END"), "c_custkey", "c_mktsegment", "x"))


def field_association(spark, sf_dir):
    return rounded(statistics.association(part_nodes(spark, sf_dir)))


def coverage_steps(spark, sf_dir):
    """Changes over the years in the share of finished orders, by priority."""
    orders = _table(spark, sf_dir, "orders")
    counts = orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("year")).agg(F.count_if(F.expr("(o_orderstatus = 'F') = (year(o_orderdate) < 1998)")).alias("hits"), F.count("*").alias("n"))
    return rounded(statistics.coverage_steps(counts, ["o_orderpriority"], effect=0.1, z=2.0))


def binomial_tails(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count_if(F.col("p_size") > 40).alias("hits"), F.count("*").alias("n"))
    return rounded(parts.withColumn("p", statistics.binomial_tail("hits", "n", F.lit(0.2))))


def mcnemar(spark, sf_dir):
    return rounded(statistics.mcnemar(_table(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("a"), (F.col("toxic") == 0).alias("b")), "a", "b"))


def balanced_sample(spark, sf_dir):
    return statistics.balanced_sample(_table(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey", 20).select("c_mktsegment", "c_custkey", "ordinal")


def value_examples(spark, sf_dir):
    return statistics.examples(_table(spark, sf_dir, "part"), ["p_brand"], "p_name").withColumn("examples", F.array_join("examples", "|"))


def parsed_dates(spark, sf_dir):
    """Order dates written in five ways and one that can't be read, read back."""
    raw = _table(spark, sf_dir, "orders").groupBy(F.expr(_DATE).alias("raw")).agg(F.count("*").alias("n"))
    return raw.withColumn("d", dated.dates(F.col("raw"))).select("raw", "n", "d.value_edtf", "d.date_earliest_single", "d.date_latest", "d.ambiguous")


# These expressions run in both dialects.
_DATE = """CASE o_orderkey % 6 WHEN 0 THEN concat(day(o_orderdate), '/', month(o_orderdate), '/', year(o_orderdate)) WHEN 1 THEN concat('c. ', year(o_orderdate))
  WHEN 2 THEN concat('before ', year(o_orderdate)) WHEN 3 THEN concat(year(o_orderdate), ' - ', year(o_orderdate) + 3)
  WHEN 4 THEN concat('early ', month(o_orderdate) + 8, 'th century') ELSE concat('lot ', day(o_orderdate)) END"""
_DIRTY = """CASE WHEN field_type <> 'p_name' THEN value WHEN CAST(record_id AS INT) % 5 = 0 THEN 'Unknown' WHEN CAST(record_id AS INT) % 5 = 1 THEN 'P Name'
  WHEN CAST(record_id AS INT) % 5 = 2 THEN concat(value, ' ;') WHEN CAST(record_id AS INT) % 5 = 3 THEN concat('<i>', value, '</i> &amp; more') ELSE 'title:' END"""
_SPELT = "CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN concat(p_name, ' (old)') WHEN 2 THEN concat(p_name, 's') WHEN 3 THEN concat('x ', p_name) ELSE p_name END"

QUERIES = {
    f.__name__: f
    for f in (
        plain_pages, question_uses, merged_proposals, disposition_census, post_conditions, base_values, inlined_groups, transferred, unanimous_flags,
        repeated_statements, reused_titles, check_failures, resolved_terms, cascaded_terms, overlaid_terms, fuzzy_terms, overlapping_spans, prefix_matches,
        coverage_queue, balance_histogram, measure_spread, chi_square, kolmogorov_smirnov, spearman, agreement, paired_change, field_association,
        coverage_steps, binomial_tails, mcnemar, balanced_sample, value_examples, parsed_dates,
    )
}

_NORM = r"trim(regexp_replace(lower({}), '\s+', ' ', 'g'), ' .,;:')"


def _plain(text: str) -> str:
    text = rf"regexp_replace(regexp_replace({text}, '<!--[\s\S]*?-->', '', 'g'), '<br[^<>]*>|</(p|div|li|tr|h[1-6])>', chr(10), 'gi')"
    text = f"regexp_replace({text}, '<[A-Za-z/!][^<>]*>', '', 'g')"
    for name, value in clean.ENTITIES:
        text = f"replace({text}, '{name}', '{value.replace(chr(39), chr(39) * 2)}')"
    return rf"trim(regexp_replace(regexp_replace({text}, '[ \t\r]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))"


_MERGED = """proposals AS (SELECT l_orderkey AS node_id, CASE WHEN l_linenumber = 3 THEN 'X' WHEN l_linenumber = 2 THEN 'O' END AS expect_value, l_returnflag AS new_value,
  concat('c', l_partkey % 3) AS component, l_linenumber % 2 AS tier, CASE WHEN l_linenumber % 4 <> 0 THEN l_discount END AS confidence FROM lineitem),
judged AS (SELECT node_id, component, new_value, tier, confidence, CASE WHEN o_orderpriority = '1-URGENT' THEN 'protected_field' WHEN expect_value <> o_orderstatus THEN 'stale_snapshot'
  WHEN new_value <> o_orderstatus THEN 'valid' END AS verdict FROM proposals JOIN orders ON node_id = o_orderkey),
merged AS (SELECT node_id, component, new_value, CASE WHEN verdict <> 'valid' THEN verdict
  WHEN row_number() OVER (PARTITION BY node_id, verdict ORDER BY tier, confidence DESC NULLS LAST, component, new_value) = 1 THEN 'applied' ELSE 'lost_precedence' END AS outcome
  FROM judged WHERE verdict IS NOT NULL)"""
_INDEX = f"""uses AS (SELECT l_partkey AS p_partkey, sum(CASE WHEN l_quantity > 45 THEN 40 ELSE 1 END) AS prominence FROM lineitem GROUP BY 1),
terms AS (SELECT {_NORM.format("concat(p_name, CASE WHEN p_partkey % 5 < 3 THEN concat(' ', p_partkey % 40) ELSE '' END)")} AS norm, p_partkey AS subject, p_brand AS kind,
  coalesce(prominence, 0) AS prominence FROM part LEFT JOIN uses USING (p_partkey))"""
_ONE = "CASE WHEN regexp_matches(norm, '(ss|us|is)$') THEN norm WHEN regexp_matches(norm, '(ch|sh|x|ss)es$') THEN regexp_replace(norm, 'es$', '') WHEN regexp_matches(norm, '[^aeiou]ies$') THEN regexp_replace(norm, 'ies$', 'y') ELSE regexp_replace(norm, 's$', '') END"
_TOKENS = "list_filter(string_split(trim(regexp_replace(lower(text), '[^0-9a-z]+', ' ', 'g')), ' '), lambda t: length(t) >= 3)"
_NOTHING = ", ".join(f"'{x}'" for x in clean.NOTHING)
_SAYS = lambda c: f"coalesce({_NORM.format(c)} IN ({_NOTHING}, 'mm', 'cm', 'in', 'kg', 'g') OR regexp_matches({c}, '^[A-Za-z ]{{1,30}}:$'), false)"

ORACLE_SQL = {
    "parsed_dates": f"""WITH r AS (SELECT o_orderkey % 6 AS k, {_DATE} AS raw, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders),
v AS (SELECT raw, k, count(*) AS n, min(y) AS y, min(m) AS m, min(d) AS d FROM r GROUP BY 1, 2), s AS (SELECT *, printf('%04d-%02d-%02d', y, m, d) AS iso, 100 * (m + 7) AS lo FROM v)
SELECT raw, n, CASE k WHEN 0 THEN iso WHEN 1 THEN y || '~' WHEN 2 THEN '../' || y WHEN 3 THEN y || '/' || (y + 3) WHEN 4 THEN printf('%04d/%04d', lo, lo + 32) END AS value_edtf,
  CASE k WHEN 0 THEN iso WHEN 1 THEN CAST(y AS VARCHAR) WHEN 3 THEN CAST(y AS VARCHAR) WHEN 4 THEN printf('%04d', lo) END AS date_earliest_single,
  CASE k WHEN 2 THEN CAST(y AS VARCHAR) WHEN 3 THEN CAST(y + 3 AS VARCHAR) WHEN 4 THEN printf('%04d', lo + 32) END AS date_latest,
  CASE WHEN k < 5 THEN k = 0 AND m <= 12 AND d <= 12 AND m <> d END AS ambiguous FROM s""",
    "plain_pages": f"SELECT page_id, md5({_plain('html')}) AS digest, CAST(length({_plain('html')}) AS INT) AS n_chars FROM pages",
    "question_uses": f"""WITH v AS (SELECT p_brand AS data_source, p_partkey % 8 AS k, list_filter(string_split_regex(lower({_ASKED}), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM part),
j AS (SELECT *, CASE WHEN len(w) >= 5 THEN CAST(len(list_filter(w, lambda x: x IN {_JOINING})) AS DOUBLE) / len(w) ELSE 0 END AS share FROM v)
SELECT data_source, CASE k WHEN 0 THEN 'link' WHEN 1 THEN 'sentence' WHEN 2 THEN 'mid_value' WHEN 7 THEN NULL ELSE 'doubt' END AS use, CAST(floor(share * 40) AS INTEGER) AS bin, count(*) AS n FROM j GROUP BY 1, 2, 3""",
    "merged_proposals": f"WITH {_MERGED} SELECT * FROM merged",
    "disposition_census": f"""WITH {_MERGED},
flags AS (SELECT l_orderkey AS node_id, min(CASE l_suppkey % 10 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 END) AS r FROM lineitem GROUP BY 1)
SELECT substr(o_orderpriority, 1, 1) AS data_source, o_orderpriority AS field_type, component,
  CASE WHEN r = 0 THEN 'qualified' WHEN component IS NOT NULL THEN 'applied' WHEN r IS NOT NULL THEN ['deferred', 'enriched', 'verified'][r - 1] ELSE 'untouched' END AS disposition, count(*) AS n
FROM orders LEFT JOIN (SELECT * FROM merged WHERE outcome = 'applied') m ON m.node_id = o_orderkey LEFT JOIN flags f ON f.node_id = o_orderkey GROUP BY ALL""",
    "post_conditions": f"""WITH {_MERGED}, c AS (SELECT o_orderkey AS node_id, o_orderpriority AS field, o_orderstatus AS recorded, coalesce(new_value, o_orderstatus) AS written FROM orders LEFT JOIN (SELECT * FROM merged WHERE outcome = 'applied') m ON m.node_id = o_orderkey),
o AS (SELECT o_orderkey AS node_id, count(*) AS before FROM orders GROUP BY 1), n AS (SELECT node_id, count(*) AS after, min(field) AS field, min(recorded) AS recorded, min(written) AS written FROM c GROUP BY 1)
SELECT count(*) FILTER (after IS NULL) AS lost, count(*) FILTER (before IS NULL) AS invented, count(*) FILTER (after > before) AS repeated, count(*) FILTER (field = '1-URGENT' AND written IS DISTINCT FROM recorded) AS protected_changed, 0 AS undecided FROM o FULL JOIN n USING (node_id)""",
    "binomial_tails": """WITH b AS (SELECT p_brand, count(*) FILTER (p_size > 40) AS hits, count(*) AS n FROM part GROUP BY 1)
SELECT p_brand, hits, n, round(CASE WHEN hits = 0 THEN 1 ELSE least(1, list_sum(list_transform(range(hits, n + 1), lambda k: exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.2) + (n - k) * ln(0.8))))) END, 9) AS p FROM b""",
    "mcnemar": """WITH c AS (SELECT count(*) FILTER (quality = 1 AND toxic <> 0) AS only_first, count(*) FILTER (quality <> 1 AND toxic = 0) AS only_second FROM labels), g AS (SELECT *, greatest(only_first, only_second) AS m, only_first + only_second AS n FROM c)
SELECT only_first, only_second, round(CASE WHEN m = 0 THEN 1 ELSE least(1, 2 * list_sum(list_transform(range(m, n + 1), lambda k: exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + n * ln(0.5))))) END, 9) AS p FROM g""",
    "base_values": f"""WITH {PART_NODES_SQL},
dirty AS (SELECT record_id, field_type, {_DIRTY} AS value FROM nodes),
texts AS (SELECT *, {_plain("CASE WHEN field_type = 'p_type' THEN lower(value) ELSE value END")} AS plain FROM dirty),
bare AS (SELECT *, CASE WHEN field_type = 'p_retailprice' THEN plain ELSE trim(plain, ' ,;:|/-') END AS own FROM texts)
SELECT record_id, field_type, CASE WHEN field_type = 'p_size' THEN value
  WHEN coalesce(own, '') <> '' AND NOT {_SAYS('plain')} AND NOT {_SAYS('own')} AND {_NORM.format('own')} <> replace(field_type, '_', ' ') THEN own END AS base_value FROM bare""",
    "inlined_groups": """WITH own AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS note, CASE WHEN c_acctbal < 0 THEN 'yes' END AS debt FROM customer),
made AS (SELECT 1 AS depth, 'doubt' AS field_type, NULL AS value, c_custkey FROM own WHERE note IS NOT NULL OR debt IS NOT NULL
  UNION ALL SELECT 2, 'note', note, c_custkey FROM own WHERE note IS NOT NULL UNION ALL SELECT 2, 'debt', debt, c_custkey FROM own WHERE debt IS NOT NULL)
SELECT depth, field_type, value, count(*) AS n, count(DISTINCT c_custkey) AS ids, count(DISTINCT c_custkey) AS parents FROM made GROUP BY 1, 2, 3""",
    "transferred": f"""WITH {PART_NODES_SQL}
SELECT record_id, min(value) FILTER (field_type = 'p_retailprice') AS value FROM nodes GROUP BY 1
HAVING count(value) FILTER (field_type = 'p_size') = 0 AND count(DISTINCT value) FILTER (field_type = 'p_retailprice') = 1""",
    "unanimous_flags": "SELECT l_orderkey, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linestatus) = 1",
    "repeated_statements": f"""WITH {ORDER_TREE_SQL},
same AS (SELECT record_id, parent_id, field_type, value, count(*) AS n FROM tree WHERE value IS NOT NULL GROUP BY ALL)
SELECT record_id, CAST(sum(n) AS BIGINT) AS statements, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS repeated FROM same GROUP BY 1""",
    "reused_titles": "SELECT CAST(p_partkey AS VARCHAR) AS record_id, p_brand AS data_source, count(*) OVER (PARTITION BY p_brand, p_name) AS reuse, count(*) OVER (PARTITION BY p_brand, p_name) < 3 AS passes FROM part",
    "check_failures": """SELECT 'cheap' AS "check", count(*) FILTER (p_size > 10) AS applicable, count(*) FILTER (p_size > 10 AND p_retailprice >= 1500) AS failed FROM part
UNION ALL SELECT 'named', count(*), count(*) FILTER (NOT regexp_matches(p_name, '^[a-z ]+$')) FROM part""",
    "resolved_terms": f"""WITH {_INDEX},
one AS (SELECT norm, subject, max(prominence) AS p, min(CASE kind WHEN 'Brand#11' THEN 0 WHEN 'Brand#22' THEN 1 WHEN 'Brand#33' THEN 2 ELSE 3 END) AS k FROM terms GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY p DESC, subject) AS r, count(*) OVER (PARTITION BY norm) AS n, min(k) OVER (PARTITION BY norm) AS best FROM one),
t AS (SELECT norm, max(n) AS n, max(subject) FILTER (r = 1) AS top, max(p) FILTER (r = 1) AS p1, coalesce(max(p) FILTER (r = 2), 0) AS p2, max(best) AS best, count(*) FILTER (k = best) AS m, min(subject) FILTER (k = best) AS s FROM r GROUP BY 1),
d AS (SELECT *, CASE WHEN n = 1 THEN 'unique' WHEN p1 >= 10 AND p1 >= 3 * (p2 + 1) THEN 'prominent' WHEN best < 3 AND m = 1 THEN 'kind' ELSE 'flagged' END AS resolved_by FROM t)
SELECT norm, CASE WHEN resolved_by IN ('unique', 'prominent') THEN top WHEN resolved_by = 'kind' THEN s END AS subject, resolved_by FROM d""",
    "cascaded_terms": f"""WITH v AS (SELECT DISTINCT {_SPELT} AS value FROM part), n AS (SELECT value, {_NORM.format('value')} AS norm FROM v),
b AS (SELECT *, {_NORM.format(r"regexp_replace(norm, '\s*\([^()]*\)', '', 'g')")} AS bare, {_ONE} AS one FROM n),
f AS (SELECT value, 0 AS t, norm FROM b UNION ALL SELECT value, 1, bare FROM b UNION ALL SELECT value, 2, one FROM b UNION ALL SELECT value, 3, string_split(bare, ' ')[-1] FROM b),
h AS (SELECT value, min(t) AS t, arg_min(norm, t) AS norm FROM f WHERE norm IN (SELECT {_NORM.format('p_name')} FROM part) GROUP BY 1)
SELECT value, norm, ['exact', 'paren', 'morph', 'compound'][t + 1] AS tier FROM v LEFT JOIN h USING (value)""",
    "overlaid_terms": """SELECT DISTINCT p_brand AS data_source, p_type AS norm, CASE WHEN p_brand < 'Brand#3' AND p_type < 'P' THEN 'own' ELSE 'pool' END AS subject,
  CASE WHEN p_brand < 'Brand#3' AND p_type < 'P' THEN 'pool' END AS crosswalk FROM part""",
    "overlapping_spans": """WITH s AS (SELECT o_orderkey, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS lo FROM orders)
SELECT s_suppkey AS query_id, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS spans FROM supplier JOIN s ON lo <= 1900 + s_suppkey * 8 AND lo + o_orderkey % 30 >= 1900 + s_suppkey * 7 GROUP BY 1""",
    "prefix_matches": f"""WITH q AS (SELECT item_id, unnest(list_distinct({_TOKENS})) AS token FROM benchmark),
d AS (SELECT DISTINCT doc_id, unnest({_TOKENS}) AS word FROM documents), w AS (SELECT DISTINCT word FROM d),
h AS (SELECT DISTINCT item_id, token, doc_id FROM q JOIN w ON starts_with(word, token) JOIN d USING (word))
SELECT h.item_id AS query_id, doc_id FROM h JOIN (SELECT item_id, count(*) AS n FROM q GROUP BY 1) s USING (item_id) GROUP BY h.item_id, doc_id, n HAVING count(*) = n""",
    "coverage_queue": """WITH c AS (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY 1, 2),
a AS (SELECT *, sum(n) OVER (PARTITION BY p_brand ORDER BY n DESC, p_name ROWS UNBOUNDED PRECEDING) - n AS above, sum(n) OVER (PARTITION BY p_brand) AS total FROM c)
SELECT p_brand, p_name, n FROM a WHERE above < 0.9 * total""",
    "balance_histogram": "SELECT CAST(least(floor(c_acctbal * 16 / 8192), 15) AS INT) AS bin, count(*) AS n FROM customer WHERE c_acctbal BETWEEN 0 AND 8192 GROUP BY 1",
    "measure_spread": """WITH r AS (SELECT l_returnflag, CAST(trunc(l_quantity) AS BIGINT) AS x FROM lineitem),
b AS (SELECT l_returnflag, least(greatest(floor(x / 8), 0), 7) AS bin, count(*) AS m FROM r GROUP BY 1, 2),
e AS (SELECT l_returnflag, CAST(sum(m) AS BIGINT) AS n, max(m) / sum(m) AS modal_share, (ln(sum(m)) - sum(m * ln(m)) / sum(m)) / ln(8) AS entropy FROM b GROUP BY 1),
q AS (SELECT l_returnflag, stddev_pop(x) AS sd, list(x ORDER BY x) AS l FROM r GROUP BY 1)
SELECT l_returnflag, n, round(sd, 9) AS sd, round(modal_share, 9) AS modal_share, round(entropy, 9) AS entropy, l[(8 * (n - 1) + 5) // 10 + 1] - l[(2 * (n - 1) + 5) // 10 + 1] AS inner_range FROM e JOIN q USING (l_returnflag)""",
    "chi_square": """WITH c AS (SELECT p_brand, p_type, p_name, count(*) AS o FROM part GROUP BY 1, 2, 3),
r AS (SELECT p_brand, p_type, sum(o) AS r FROM c GROUP BY 1, 2), k AS (SELECT p_brand, p_name, sum(o) AS k FROM c GROUP BY 1, 2), n AS (SELECT p_brand, sum(o) AS n FROM c GROUP BY 1),
x AS (SELECT p_brand, n, sum((coalesce(o, 0) - r * k / n) ** 2 / (r * k / n)) AS chi2, count(DISTINCT p_type) AS a, count(DISTINCT p_name) AS b
  FROM r JOIN k USING (p_brand) JOIN n USING (p_brand) LEFT JOIN c USING (p_brand, p_type, p_name) GROUP BY 1, 2)
SELECT p_brand, CAST(n AS BIGINT) AS n, round(chi2, 9) AS chi2, (a - 1) * (b - 1) AS dof, round(CASE WHEN least(a, b) > 1 THEN sqrt(chi2 / n / (least(a, b) - 1)) END, 9) AS cramers_v FROM x""",
    "kolmogorov_smirnov": """WITH v AS (SELECT l_linenumber, l_quantity AS x, count(*) FILTER (l_linestatus <> 'O') AS a, count(*) FILTER (l_linestatus = 'O') AS b FROM lineitem GROUP BY 1, 2),
c AS (SELECT l_linenumber, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER g AS n1, sum(b) OVER g AS n2 FROM v
  WINDOW w AS (PARTITION BY l_linenumber ORDER BY x ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY l_linenumber)),
d AS (SELECT l_linenumber, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, max(abs(ca / n1 - cb / n2)) AS d FROM c WHERE n1 > 0 AND n2 > 0 GROUP BY 1, 2, 3),
s AS (SELECT *, d * d * n1 * n2 / (n1 + n2) AS s FROM d)
SELECT l_linenumber, n1, n2, round(d, 9) AS d, round(CASE WHEN s < 0.04 THEN 1 ELSE least(greatest(list_sum(list_transform(range(1, 101), lambda j: (CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END) * exp(-2 * j * j * s))), 0), 1) END, 9) AS p FROM s""",
    "spearman": """WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2 AS x,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_returnflag, l_discount) - 1) / 2 AS y FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(corr(x, y), 9) AS rho FROM r GROUP BY 1""",
    "agreement": """WITH k AS (SELECT l_returnflag, l_orderkey, l_linenumber, bool_or(l_quantity > 20) AS f, bool_or(l_discount > 0.04) AS g FROM lineitem GROUP BY 1, 2, 3),
s AS (SELECT l_returnflag, count(*) FILTER (f) AS found, count(*) FILTER (g) AS gold, count(*) FILTER (f AND g) AS hits FROM k GROUP BY 1)
SELECT *, round(hits / found, 9) AS precision, round(hits / gold, 9) AS recall, round(2 * hits / (found + gold), 9) AS f1 FROM s""",
    "paired_change": """WITH r AS (SELECT c_mktsegment, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS x, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal * 2 END AS y FROM customer)
SELECT c_mktsegment, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS paired, round(avg(x) FILTER (y IS NOT NULL), 9) AS mean_before, round(avg(y) FILTER (x IS NOT NULL), 9) AS mean_after,
  count(*) FILTER (x IS NULL AND y IS NOT NULL) AS gained, count(*) FILTER (x IS NOT NULL AND y IS NULL) AS lost FROM r GROUP BY 1""",
    "field_association": f"""WITH {PART_NODES_SQL},
h AS (SELECT DISTINCT record_id, field_type FROM nodes WHERE value IS NOT NULL), n AS (SELECT CAST(count(DISTINCT record_id) AS DOUBLE) AS n FROM nodes), c AS (SELECT field_type, CAST(count(*) AS DOUBLE) AS c FROM h GROUP BY 1),
p AS (SELECT x.field_type, y.field_type AS other, count(*) AS ab FROM h x JOIN h y ON x.record_id = y.record_id AND x.field_type < y.field_type GROUP BY 1, 2)
SELECT p.field_type, other, round(CASE WHEN a.c * b.c * (n - a.c) * (n - b.c) > 0 THEN (n * ab - a.c * b.c) / sqrt(a.c * b.c * (n - a.c) * (n - b.c)) END, 9) AS phi
FROM p JOIN c a ON a.field_type = p.field_type JOIN c b ON b.field_type = other CROSS JOIN n""",
    "balanced_sample": """WITH r AS (SELECT c_mktsegment, c_custkey, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('0:' || c_custkey), c_custkey) AS INT) AS ordinal FROM customer)
SELECT * FROM r WHERE ordinal <= 20""",
    "value_examples": "SELECT p_brand, count(*) AS n, array_to_string(list_sort(list_distinct(list(p_name)))[1:3], '|') AS examples FROM part GROUP BY 1",
}
