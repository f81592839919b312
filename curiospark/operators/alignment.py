"""Matching values with a vocabulary: forms, homographs, near spellings, overlays, spans, prefixes."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import norm_term


def forms(value: Column) -> Column:
    """(tier, norm) of the forms under which a value is looked up, from the surest: as it is, without brackets, singular."""
    norm = norm_term(value)
    bare = norm_term(F.regexp_replace(norm, r"\s*\([^()]*\)", ""))
    one = F.when(norm.rlike("(ss|us|is)$"), norm).when(norm.rlike("(ch|sh|x|ss)es$"), F.regexp_replace(norm, "es$", "")).when(norm.rlike("[^aeiou]ies$"), F.regexp_replace(norm, "ies$", "y")).otherwise(F.regexp_replace(norm, "s$", ""))
    head = F.element_at(F.split(bare, " "), -1)
    tiers = enumerate((norm, bare, one, head))
    return F.array(*[F.struct(F.lit(n).alias("tier"), form.alias("norm")) for n, form in tiers])


TIERS = ("exact", "paren", "morph", "compound")


def cascade(values: DataFrame, value: str, index: DataFrame) -> DataFrame:
    """value, norm, tier by the first form that the vocabulary has; values with none stay, with nulls.

    All forms are looked up by one join, rather than tier by tier over what is left.
    """
    asked = values.select(value).distinct().select(value, F.inline(forms(F.col(value))))
    hit = asked.join(index.select("norm").distinct().withColumn("hit", F.lit(1)), "norm", "left")
    best = F.min(F.when(F.col("hit") == 1, F.struct("tier", "norm")))
    names = F.array(*[F.lit(t) for t in TIERS])
    return hit.groupBy(value).agg(best.alias("b")).select(value, "b.norm", F.get(names, F.col("b.tier")).alias("tier"))


def resolve_homographs(index: DataFrame, kinds: Sequence[str], least: int = 10, factor: int = 3) -> DataFrame:
    """norm, subject, resolved_by for every term of ``index`` (norm, subject, kind, prominence).

    The only subject; the prominent one, with ``least`` uses and ``factor`` times those of the next plus one; the only
    subject of the most preferred of ``kinds`` that is there; else none, "flagged".
    """
    one = index.groupBy("norm", "subject").agg(F.max("prominence").alias("prominence"), F.min(F.coalesce(*[F.when(F.col("kind") == k, F.lit(n)) for n, k in enumerate(kinds)], F.lit(len(kinds)))).alias("k"))
    order = Window.partitionBy("norm").orderBy(F.desc_nulls_last("prominence"), "subject")
    first = one.withColumn("r", F.row_number().over(order)).where("r <= 2")
    first = first.groupBy("norm").agg(F.max(F.when(F.col("r") == 1, F.col("subject"))).alias("top"), F.max(F.when(F.col("r") == 1, F.col("prominence"))).alias("p1"), F.coalesce(F.max(F.when(F.col("r") == 2, F.col("prominence"))), F.lit(0)).alias("p2"), F.count("*").alias("n"))
    by_kind = one.groupBy("norm", "k").agg(F.count("*").alias("m"), F.min("subject").alias("s"))
    by_kind = by_kind.groupBy("norm").agg(F.min(F.struct("k", "m", "s")).alias("b"))
    both = first.join(by_kind, "norm")
    rung = F.when(F.col("n") == 1, "unique").when((F.col("p1") >= least) & (F.col("p1") >= factor * (F.col("p2") + 1)), "prominent").when((F.col("b.k") < len(kinds)) & (F.col("b.m") == 1), "kind").otherwise("flagged")
    both = both.withColumn("resolved_by", rung)
    subject = F.when(F.col("resolved_by").isin("unique", "prominent"), F.col("top")).when(F.col("resolved_by") == "kind", F.col("b.s"))
    return both.select("norm", subject.alias("subject"), "resolved_by")


def overlay(pooled: DataFrame, house: DataFrame) -> DataFrame:
    """A source's own list displaces the pooled match, which is kept as crosswalk: both are (data_source, norm, subject)."""
    own = house.withColumnRenamed("subject", "own")
    both = pooled.join(own, ["data_source", "norm"], "left")
    return both.select("data_source", "norm", F.coalesce("own", "subject").alias("subject"), F.when(F.col("own") != F.col("subject"), F.col("subject")).alias("crosswalk"))


def indel_ratio(a: str, b: str) -> float:
    """1 less the insertions and deletions from a to b over both lengths; bits of an integer hold a row of the table."""
    if not a and not b:
        return 1.0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        common = row & at.get(c, 0)
        row = ((row + common) | (row - common)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([indel_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def fuzzy_join(queries: DataFrame, terms: DataFrame, hundredths: int = 93) -> DataFrame:
    """norm, term, ratio: of each query the term of the highest ratio that reaches the floor, ties to the smaller term.

    Exact: a term that a query reaches with d edits, cut into d + 1 pieces, has a piece that the query holds at most
    d places away. The most edits follow from the term's length, so pieces and the places to look are columns.
    """
    lose = 100 - hundredths
    # d <= lose (lq + lt) / 100 and lq <= lt (100 + lose) / hundredths, so d <= most(lt)
    most = lambda n: F.floor(n * 2 * lose / hundredths + 1e-9).cast("int")
    piece = lambda n, d, i: F.floor(n * i / (d + 1)).cast("int")
    t = terms.select(F.col("norm").alias("term")).where(F.length("term") > 0).distinct().withColumn("n", F.length("term")).withColumn("d", most(F.col("n")))
    cut = lambda i: F.struct(i.alias("i"), F.substring("term", piece(F.col("n"), F.col("d"), i) + 1, piece(F.col("n"), F.col("d"), i + 1) - piece(F.col("n"), F.col("d"), i)).alias("piece"))
    pieces = t.select("term", "n", F.inline(F.transform(F.sequence(F.lit(0), F.col("d")), cut)))
    q = queries.select("norm").where(F.length("norm") > 0).distinct().withColumn("l", F.length("norm"))
    lengths = F.sequence(F.ceil(F.col("l") * hundredths / (100 + lose)).cast("int"), F.floor(F.col("l") * (100 + lose) / hundredths).cast("int"))
    q = q.select("norm", "l", F.explode(lengths).alias("n")).withColumn("d", most(F.col("n")))
    q = q.select("*", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("i"))
    start = piece(F.col("n"), F.col("d"), F.col("i"))
    q = q.withColumn("start", start).withColumn("size", piece(F.col("n"), F.col("d"), F.col("i") + 1) - start)
    q = q.select("norm", "n", "i", "size", F.explode(F.sequence(F.greatest(F.col("start") - F.col("d"), F.lit(0)), F.col("start") + F.col("d"))).alias("at"), "l")
    q = q.where(F.col("at") + F.col("size") <= F.col("l")).select("norm", "n", "i", F.substring(F.col("norm"), F.col("at") + 1, F.col("size")).alias("piece")).distinct()
    pairs = q.join(pieces, ["n", "i", "piece"]).select("norm", "term").distinct().withColumn("ratio", _ratio("norm", "term"))
    good = pairs.where(F.col("ratio") * 100 >= hundredths - 1e-9)
    return good.groupBy("norm").agg(F.min(F.struct((-F.col("ratio")).alias("r"), "term")).alias("b")).select("norm", "b.term", (-F.col("b.r")).alias("ratio"))


def _ordered(n: Column) -> Column:
    """A long with its sign bit turned, so that its bits as they stand are in the order of numbers."""
    return n.cast("long").bitwiseXOR(F.lit(-(2**63)))


def _node(n: Column, k: Column) -> Column:
    """The node of level k that n is in: it holds the numbers that differ in their last k bits only, and is the left or right one of a pair by its last bit."""
    return F.call_function("shiftrightunsigned", n, k)


def _levels(most: int = 63) -> Column:
    return F.sequence(F.lit(0), F.lit(most))


def _right(n: Column, k: Column) -> Column:
    return _node(n, k).bitwiseAND(F.lit(1)) == 1


def _other(n: Column, k: Column) -> Column:
    return F.struct(k.alias("level"), _node(n, k).bitwiseXOR(F.lit(1)).alias("node"))


def _single(n: Column) -> Column:
    return F.struct(F.lit(0).alias("level"), n.alias("node"))


def _below(n: Column, also: bool) -> Column:
    """(level, node) of disjoint nodes that hold all numbers below n, or up to n."""
    left = F.transform(F.filter(_levels(), lambda k: _right(n, k)), lambda k: _other(n, k))
    return F.concat(left, F.array(_single(n))) if also else left


def _prefix_sums(bounds: DataFrame, points: DataFrame, also: bool) -> DataFrame:
    """query_id, n, total over the points (at, n, total) below or up to each bound (query_id, at)."""
    usable = F.filter(_levels(), lambda k: (k == 0) | ~_right(F.col("at"), k))
    ups = F.transform(usable, lambda k: F.struct(k.alias("level"), _node(F.col("at"), k).alias("node")))
    sums = points.select(F.explode(ups).alias("p"), "n", "total").groupBy("p.level", "p.node").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return bounds.select("query_id", F.inline(_below(F.col("at"), also))).join(sums, ["level", "node"]).select("query_id", "n", "total")


def overlap_totals(queries: DataFrame, spans: DataFrame) -> DataFrame:
    """query_id, n, spans: how many spans share a value with the queries of that id, and the sum of their ids.

    Spans that begin up to the query's end, less those that end before it begins. Sums over nodes of 1, 2, 4, ... numbers make up both, so that
    neither pairs nor the values of a span are listed; a query reads at most 64 nodes for each.
    """
    asked, own = queries.where("lo <= hi").select("query_id", "lo", "hi"), spans.where("lo <= hi")
    at = lambda name: own.groupBy(_ordered(F.col(name)).alias("at")).agg(F.count("*").alias("n"), F.sum("span_id").cast("decimal(38,0)").alias("total"))
    begun = _prefix_sums(asked.select("query_id", _ordered(F.col("hi")).alias("at")), at("lo"), also=True)
    ended = _prefix_sums(asked.select("query_id", _ordered(F.col("lo")).alias("at")), at("hi"), also=False)
    both = begun.unionByName(ended.select("query_id", (-F.col("n")).alias("n"), (-F.col("total")).alias("total")))
    return both.groupBy("query_id").agg(F.sum("n").alias("n"), F.sum("total").cast("long").alias("spans")).where("n > 0")


def overlaps(queries: DataFrame, spans: DataFrame, width: int = 10) -> DataFrame:
    """Pairs of query (query_id, lo, hi) and span (span_id, lo, hi) that share a value. ``width`` is of no effect any more.

    Of such a pair either the span begins within the query, or the query begins within the span, but not with it. An interval is cut into at most
    126 nodes of 1, 2, 4, ... numbers and a number is in one node of each size, so that each pair is met once, and no other.
    """
    q, s = queries.where("lo <= hi").select("query_id", "lo", "hi"), spans.where("lo <= hi").select("span_id", "lo", "hi")
    after = s.where("lo < hi").select("span_id", (F.col("lo") + 1).alias("lo"), "hi")
    return _within(q, s, "query_id", "span_id").unionByName(_within(after, q, "span_id", "query_id"))


def _within(intervals: DataFrame, points: DataFrame, key: str, other: str) -> DataFrame:
    """key, other where ``lo`` of ``points`` is in the interval."""
    lo, hi = F.col("a"), F.col("b")
    # Up to the pair in which both ends meet: what is right of the lower end and left of the upper one.
    apart = F.filter(_levels(62), lambda k: _node(lo, k + 1) != _node(hi, k + 1))
    right = F.transform(F.filter(apart, lambda k: ~_right(lo, k)), lambda k: _other(lo, k))
    left = F.transform(F.filter(apart, lambda k: _right(hi, k)), lambda k: _other(hi, k))
    nodes = intervals.select(key, _ordered(F.col("lo")).alias("a"), _ordered(F.col("hi")).alias("b"))
    nodes = nodes.select(key, F.inline(F.concat(right, left, F.when(lo == hi, F.array(_single(lo))).otherwise(F.array(_single(lo), _single(hi))))))
    used = F.broadcast(nodes.groupBy().agg(F.collect_set("level").alias("used")))
    at = points.select(other, _ordered(F.col("lo")).alias("at")).crossJoin(used)
    at = at.select(other, F.inline(F.transform("used", lambda k: F.struct(k.alias("level"), _node(F.col("at"), k).alias("node")))))
    return nodes.join(at, ["level", "node"]).select(key, other)


def prefix_matches(queries: DataFrame, texts: DataFrame, longest: int = 12) -> DataFrame:
    """query_id, doc_id where every token of the query begins a word of the text.

    Both are (id, tokens). Words are cut to the lengths that the queries' tokens have, and joined on equality; a token
    of more than ``longest`` letters is first joined by that many and then compared whole. A text is looked at for a query only
    where it has a word that the query's rarest token begins; the words of these tokens, no more than such pairs, are broadcast.
    """
    asked = queries.groupBy("query_id").agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("asked"))
    tokens = asked.select("query_id", F.explode("asked").alias("token"))
    words = texts.select("doc_id", F.explode(F.array_distinct("tokens")).alias("word")).where("word <> ''")
    each = tokens.select("token").distinct().withColumn("start", F.substring("token", 1, longest))
    lengths = F.broadcast(each.where("start <> ''").select(F.length("start").alias("k")).distinct())
    vocabulary = words.groupBy("word").agg(F.count("*").alias("df"))
    starts = vocabulary.join(lengths, F.length("word") >= F.col("k")).withColumn("start", F.expr("substring(word, 1, k)"))
    # Both uses need df, so that they share one count of the words.
    hits = each.join(starts, "start").where(F.expr("startswith(word, token)") & (F.col("df") > 0)).select("token", "word", "df")
    uses = tokens.join(hits.groupBy("token").agg(F.sum("df").alias("uses")), "token", "left")
    rarest = uses.groupBy("query_id").agg(F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "token"))["token"].alias("token"))
    near = words.join(F.broadcast(rarest.join(hits, "token").select("query_id", "word")), "word").select("query_id", "doc_id").distinct()
    pairs = texts.withColumnRenamed("doc_id", "id").join(near.join(asked, "query_id"), F.col("id").eqNullSafe(F.col("doc_id")))
    begins = lambda t: (F.length(t) > 0) & F.exists("tokens", lambda w: F.coalesce(w.startswith(t), F.lit(False)))
    found = pairs.select("query_id", "doc_id", F.size("asked").alias("n"), F.filter("asked", begins).alias("found"))
    whole = found.groupBy("query_id", "doc_id").agg(F.max("n").alias("n"), F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("m"))
    return whole.where("m = n").select("query_id", "doc_id")


def coverage_queue(values: DataFrame, group: str, weight: str, tie: str, share: float) -> DataFrame:
    """The heaviest values of each group, up to the one with which they reach ``share`` of its weight."""
    own = Window.partitionBy(group)
    above = F.coalesce(F.sum(weight).over(own.orderBy(F.desc(weight), tie).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = values.withColumn("above", above).withColumn("total", F.sum(weight).over(own))
    return held.where(F.col("above") < share * F.col("total")).drop("above", "total")
