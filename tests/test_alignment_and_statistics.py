"""Operators that SQL can't express, against plain versions on small rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from curiospark.functions import clean
from curiospark.operators import alignment, compile, statistics


def longest_common(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_indel_ratio_is_that_of_the_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        want = 2 * longest_common(a, b) / (len(a) + len(b)) if a or b else 1.0
        assert alignment.indel_ratio(a, b) == pytest.approx(want)


@pytest.mark.parametrize("floor", [80, 93])
def test_fuzzy_join_finds_what_comparing_all_finds(spark, floor):
    rng = random.Random(floor)
    terms = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 40))) for _ in range(120)})
    queries = set()
    for t in terms:
        q = list(t)
        for _ in range(rng.randrange(4)):
            q.insert(rng.randrange(len(q) + 1), rng.choice("abcd")) if rng.random() < 0.5 or not q else q.pop(rng.randrange(len(q)))
        queries.add("".join(q))
    want = {}
    for q in queries - {""}:
        scored = [(-alignment.indel_ratio(q, t), t) for t in terms if alignment.indel_ratio(q, t) * 100 >= floor - 1e-9]
        if scored:
            want[q] = min(scored)[1]
    asked = spark.createDataFrame([(q,) for q in queries] + [(None,), ("",)], "norm string")
    got = alignment.fuzzy_join(asked, spark.createDataFrame([(t,) for t in terms] + [(None,)], "norm string"), floor)
    assert {r.norm: r.term for r in got.collect()} == want and len(want) > 60


def test_binomial_tail_is_the_sum_of_its_terms(spark):
    cases = [(k, n, p) for n in (1, 5, 40, 900) for k in (0, 1, n // 3, n) for p in (0.0, 0.02, 0.5, 0.93, 1.0)]
    got = spark.createDataFrame(cases, "k int, n int, p double").withColumn("t", statistics.binomial_tail("k", "n", "p")).collect()
    for k, n, p, t in got:
        assert t == pytest.approx(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1)), rel=1e-8, abs=1e-12)


def test_coverage_steps_find_the_years_of_change(spark):
    rows = [("a", y, 20 if y < 1990 else 180, 200) for y in range(1980, 2000)] + [("b", y, 100, 200) for y in range(1980, 2000)] + [("c", y, 0, 10) for y in range(1980, 1990)]
    rows += [("d", y, 10 if y < 1985 or y >= 1995 else 190, 200) for y in range(1980, 2000)]
    got = statistics.coverage_steps(spark.createDataFrame(rows, "source string, year int, hits int, n int"), ["source"]).collect()
    assert sorted((r.source, r.year, r.change > 0) for r in got) == [("a", 1990, True), ("d", 1985, True), ("d", 1995, False)]


def test_mcnemar(spark):
    rows = [(True, False)] * 8 + [(False, True)] * 2 + [(True, True)] * 5
    row = statistics.mcnemar(spark.createDataFrame(rows, "a boolean, b boolean"), "a", "b").head()
    assert (row.only_first, row.only_second) == (8, 2) and row.p == pytest.approx(2 * (45 + 10 + 1) / 1024)


def test_merge_outcomes(spark):
    base = spark.createDataFrame([(1, "x", "f"), (2, None, "f"), (3, "z", "key")], "node_id int, base_value string, field_type string")
    proposals = [(1, "x", "a", "one", 1, None), (1, None, "b", "two", 0, 0.5), (1, None, "c", "one", 0, None), (1, "old", "d", "two", 0, 1.0), (1, None, "x", "one", 0, 1.0), (2, None, "new", "one", 0, None), (3, None, "q", "one", 0, None), (9, None, "q", "one", 0, None)]
    got = compile.merge(base, spark.createDataFrame(proposals, "node_id int, expect_value string, new_value string, component string, tier int, confidence double"), ["key"])
    assert sorted((r.node_id, r.new_value, r.outcome) for r in got.collect()) == [
        (1, "a", "lost_precedence"), (1, "b", "applied"), (1, "c", "lost_precedence"), (1, "d", "stale_snapshot"), (2, "new", "applied"), (3, "q", "protected_field"),
    ]


def test_post_conditions_name_what_broke(spark):
    base = spark.createDataFrame([(1, "f", "x"), (2, "key", "y"), (3, "f", "z")], "node_id int, field_type string, value string")
    broken = spark.createDataFrame([(1, "x", "applied"), (1, "x", None), (2, "changed", "applied"), (4, "n", "applied")], "node_id int, compiled_value string, disposition string")
    assert compile.post_conditions(base, broken, ["key"]).head().asDict() == {"lost": 1, "invented": 1, "repeated": 1, "protected_changed": 1, "undecided": 1}


def test_plain_text_of_markup(spark):
    cases = {"<p>a&amp;lt; b</p><br/>c<!-- x\ny -->d": "a&lt; b\ncd", "1 < 2 and 3 > 2": "1 < 2 and 3 > 2", None: None, "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.t for r in df.select("v", clean.plain(F.col("v")).alias("t")).collect()} == cases
