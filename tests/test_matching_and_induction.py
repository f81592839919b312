"""Matching, induced separators, closures and records against small cases."""

import json

import pytest
from pyspark.sql import functions as F

from curiospark.operators import induction, matching, ranked
from curiospark.sources import records


def test_separators_are_induced_in_rounds(spark):
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("ok", "il")]
    rows = [("g", "s", w, 6) for w in words]
    rows += [("g", "s", f"{a} / {b}", 30) for a, b in zip(words, words[1:])]
    rows += [("g", "s", f"{a} / {b} & {c}", 9) for a, b, c in zip(words, words[1:], words[2:])] + [("g", "s", "12/13", 500)]
    values = spark.createDataFrame(rows, "`group` string, data_source string, value string, count long").withColumn("norm", F.col("value"))
    limits = induction.Limits(literal=100, connective=100, fragments=10, support=100)
    found = induction.separator_candidates(values, limits)
    admitted = found.where("reason is null")
    assert {r.separator for r in admitted.collect()} == {"/", "&"}
    attested = values.where("count = 6").select("group", "norm")
    got = {(r.separator, r.round) for r in induction.induce_separators(values, admitted, attested, limits).collect()}
    assert got == {("/", 1), ("&", 2)} or got == {("/", 1), ("&", 1)}
    parts = induction.split_on(values.where("value = 'aok / ail & bok' or value = '12/13'"), spark.createDataFrame([("g", "s", "/", 1), ("g", "s", "&", 1)], "`group` string, data_source string, separator string, round int"))
    assert sorted(r.value for r in parts.collect()) == ["12/13", "ail", "aok", "bok"]


def test_damaged_letters_are_anchored(spark):
    damaged = spark.createDataFrame([("caf�",), ("D�rer",), ("��tui",), ("18�",), ("a.b�",)], "value string")
    tokens = spark.createDataFrame([("café",), ("cafe",), ("Dürer",), ("étui",), ("18°",), ("a.bé",), ("axbé",)], "token string")
    assert {tuple(r) for r in matching.anchored(damaged, tokens).collect()} == {("caf�", "café"), ("D�rer", "Dürer"), ("��tui", "étui"), ("a.b�", "a.bé")}


def test_relaxed_union_refuses_what_has_no_common_type(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([([1],)], "v array<int>")
    with pytest.raises(ValueError):
        matching.union_relaxed(a, b)


def test_closure_ends_in_cycles_and_raises_beyond_its_depth(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(6)] + [(20, 21), (21, 20)], "c int, p int")
    got = {(r.subject, r.ancestor): r.steps for r in ranked.closure(edges, "c", "p").collect()}
    assert got == {(a, b): b - a for a in range(6) for b in range(a + 1, 7)} | {(20, 21): 1, (21, 20): 1, (20, 20): 2, (21, 21): 2}
    with pytest.raises(ValueError):
        ranked.closure(edges, "c", "p", 3)


def test_unknown_keys_are_spilled(spark):
    line = json.dumps({"@admin": {"uuid": "u", "shelf": 3, "data_source": {"name": "n", "city": "x"}}, "@document": {"units": [], "pages": [1]}, "more": {"a": 1}})
    row = records.parse_records(spark.createDataFrame([(line,), ("{broken",), (None,)], "value string")).collect()
    assert json.loads(row[0].extra) == {"more": '{"a":1}', "@admin.shelf": "3", "@admin.data_source.city": "x", "@document.pages": "[1]"}
    assert row[1].extra is None and row[2].record_id is None
