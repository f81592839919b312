"""What operators put into one place, on rows that would put too much there, and their results against plain versions."""

import random

import pytest

from curiospark.operators import alignment, census, matching
from curiospark.plans import census_queries, stage_queries
from curiospark.sources.dealt import dealt

QUERIES = stage_queries.QUERIES | census_queries.QUERIES


def plans(plan):
    """All nodes of a plan that has run."""
    yield plan
    name = plan.nodeName()
    below = [plan.executedPlan()] if name.startswith("AdaptiveSparkPlan") else [plan.plan()] if name.endswith("QueryStage") else [plan.children().apply(i) for i in range(plan.children().size())]
    for p in below:
        yield from plans(p)


def most_rows(df):
    """The rows of the largest step of a query that has run."""
    counts = [p.metrics().get("numOutputRows") for p in plans(df._jdf.queryExecution().executedPlan())]
    return max(c.get().value() for c in counts if c.isDefined())


def test_targets_do_not_meet_all_candidates_of_their_head(spark):
    targets = spark.range(2000).selectExpr("id AS norm", "'h' AS head", "CASE id % 3 WHEN 0 THEN array() WHEN 1 THEN array('a') ELSE array('b', 'a') END AS context")
    index = spark.range(2000).selectExpr("'h' AS head", "id AS subject", "array(CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END, 'c') AS known", "id % 7 AS prominence")
    got = matching.resolve_in_context(targets, index)
    rows = {r.norm: (r.n_candidates, r.n_full, r.subject, r.resolved_by) for r in got.collect()}
    assert len(rows) == 2000 and (rows[0], rows[1], rows[2]) == ((2000, 2000, 6, None), (2000, 1000, 6, None), (2000, 0, 6, None))
    assert most_rows(got) < 20_000


def test_resolving_in_context_equals_comparing_all(spark):
    rng = random.Random(3)
    some = lambda: rng.choice([None, [], *([rng.choice(["a", "b", "c", None]) for _ in range(rng.randrange(1, 4))] for _ in range(4))])
    index = [(rng.choice("hijk"), rng.randrange(8), some(), rng.choice([None, 1, 2, 3, 5000])) for _ in range(14)] + [("l", 1, ["a"], 3), ("m", 1, ["a"], 9000), ("m", 2, ["b"], 2)]
    targets = [(rng.randrange(60), rng.choice("hijklmn"), some()) for _ in range(90)]
    want = {}
    for norm, head in {(n, h) for n, h, _ in targets}:
        cands = [(s, k, p) for h, s, k, p in index if h == head]
        contexts = [c for n, h, c in targets if (n, h) == (norm, head)]
        if not cands:
            continue
        order = sorted({(-1 if p is None else p, -s) for s, _, p in cands}, reverse=True)
        full = [(-1 if p is None else p, -s) for c in contexts for s, k, p in cands if c is not None and k is not None and set(c) <= set(k)]
        stated, n = any(contexts), len({s for s, _, _ in cands})
        second = max(order[1][0], 0) if len(order) > 1 else 0
        by = ("context_full" if len(full) == 1 else None) if stated else "unique" if n == 1 else "prominent" if order[0][0] >= 1000 and order[0][0] >= 10 * (second + 1) else None
        want[norm, n, len(full), -max(full or order)[1], by] = want.get((norm, n, len(full), -max(full or order)[1], by), 0) + 1
    got = matching.resolve_in_context(spark.createDataFrame(targets, "norm int, head string, context array<string>"), spark.createDataFrame(index, "head string, subject int, known array<string>, prominence int"))
    found = {}
    for r in got.collect():
        found[tuple(r)] = found.get(tuple(r), 0) + 1
    assert found == want and {k[4] for k in want} == {None, "context_full", "unique", "prominent"}


def test_overlaps_of_spans_of_any_width(spark):
    rng = random.Random(9)
    least, most = -(2**63), 2**63 - 1
    ends = [least, least + 1, -(10**12), -9, -1, 0, 1, 7, 8, 30, 10**12, most - 1, most]
    some = lambda: rng.choice(ends) if rng.random() < 0.4 else rng.randrange(-20, 60)
    queries, spans = ([(i, some(), some()) for i in range(n)] for n in (120, 150))
    want = sorted((q, s) for q, a, b in queries for s, c, d in spans if a <= b and c <= d and a <= d and c <= b)
    asked, own = spark.createDataFrame(queries, "query_id long, lo long, hi long"), spark.createDataFrame(spans, "span_id long, lo long, hi long")
    assert sorted(map(tuple, alignment.overlaps(asked, own).collect())) == want
    totals = {}
    for q, s in want:
        n, total = totals.get(q, (0, 0))
        totals[q] = n + 1, total + s
    assert {r.query_id: (r.n, r.spans) for r in alignment.overlap_totals(asked, own).collect()} == totals


def test_totals_of_overlaps_list_no_pairs(spark):
    queries, spans = spark.range(300).selectExpr("id AS query_id", "0 AS lo", "1000000000 AS hi"), spark.range(3000).selectExpr("id AS span_id", "id % 50 AS lo", "id % 50 + 5 AS hi")
    got = alignment.overlap_totals(queries, spans)
    assert {(r.n, r.spans) for r in got.collect()} == {(3000, 4498500)} and most_rows(got) < 20_000


def test_texts_are_looked_at_by_the_rarest_token(spark):
    texts = spark.range(3000).selectExpr("id AS doc_id", "array('every', 'common', 'wordy', concat('w', id + 10000), NULL) AS tokens")
    asked = spark.range(40).selectExpr("id AS query_id", "array('ev', 'com', 'word', concat('w', id * 70 + 10200)) AS tokens")
    got = alignment.prefix_matches(asked, texts)
    assert sorted(map(tuple, got.collect())) == sorted((i, i * 70 + 200) for i in range(40))
    assert most_rows(got) < 100_000


def test_prefix_matches_equal_comparing_all(spark):
    rng = random.Random(4)
    word = lambda most: "".join(rng.choice("ab") for _ in range(rng.randrange(1, most)))
    texts = [(rng.choice([*range(50), None]), [rng.choice([word(17), word(17), "", None]) for _ in range(rng.randrange(9))]) for _ in range(80)]
    queries = [(i, [word(16) if rng.random() < 0.3 else word(4) for _ in range(rng.randrange(4))]) for i in range(60)] + [(60, ["a", ""]), (61, ["a", None]), (62, None)]
    of = {}
    for d, t in texts:
        of.setdefault(d, set()).update(w for w in t if w)
    want = {(q, d) for q, t in queries if t and all(t) for d, ws in of.items() if all(any(w.startswith(x) for w in ws) for x in t)}
    got = alignment.prefix_matches(spark.createDataFrame(queries, "query_id int, tokens array<string>"), spark.createDataFrame(texts, "doc_id int, tokens array<string>"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 100 and any(d is None for _, d in want)


def test_rows_are_dealt_by_their_number(spark):
    assert dealt(spark.range(10), "id", 10).rdd.getNumPartitions() == spark.range(10).rdd.getNumPartitions()
    deal = dealt(spark.range(0, 95, 1, 1), "id", 10)
    assert deal.rdd.getNumPartitions() == 10 and sorted(r.id for r in deal.collect()) == list(range(95))


def scan_of_one_task(spark, tmp_path, name):
    """A folder whose table ``name`` is one compact file of 120,000 rows, and few rows of the others."""
    from pyspark.sql import functions as F

    for table, key in (("part", "p_partkey"), ("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        own = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(100).coalesce(1)
        more = own.crossJoin(spark.range(1200 if table == name else 1).withColumnRenamed("id", "i")).withColumn(key, F.col(key) + F.col("i") * 100_000).drop("i")
        more.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    return str(tmp_path)


def widest(df):
    """The most tasks of a shuffle of a query."""
    found = [p.outputPartitioning().numPartitions() for p in plans(df._jdf.queryExecution().executedPlan()) if p.nodeName() == "Exchange"]
    return max(found, default=0)


@pytest.mark.parametrize(("query", "table", "least"), [("merged_proposals", "orders", 2), ("conformance", "part", 3), ("base_values", "part", 3), ("inlined_groups", "customer", 3), ("placed_in_context", "part", 3)])
def test_compact_files_are_dealt_to_several_tasks(spark, tmp_path, query, table, least):
    sf_dir, before = scan_of_one_task(spark, tmp_path, table), spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = QUERIES[query](spark, sf_dir)
        got.collect()
        assert widest(got) >= least and rows >= 110_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_conformance_counts_repeated_nodes_as_often_as_they_occur(spark):
    nodes = [("r", "s", 0, "count", "3"), ("r", "s", 0, "count", "3"), ("r", "s", 0, "count", "x"), ("q", None, 0, "title", "lamp"), ("q", None, 0, "count", "1")]
    found = census.conformance(spark.createDataFrame(nodes, "record_id string, data_source string, parent_id int, field_type string, value string"), "title", "descr", "objnum", ["made"], ["descr"], ["title", "count"], ["count"], ["objnum"])
    got = {r.record_id: (r.pass_duplicate_stmt, r.pass_model_typed, r.pass_reuse) for r in found.collect()}
    assert got == {"r": (False, 2 / 3, None), "q": (True, 1.0, True)}
