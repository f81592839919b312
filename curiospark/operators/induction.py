"""Separators and patterns induced from the values themselves."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_term

# What never separates, words that may, and limits.
PAIRING, BASE, WORDS, TIGHT = r"[()\[\]{}\"'«»]", (";", "|"), ("and", "or"), ("-", "'", "’")


@dataclass(frozen=True)
class Limits:
    """Least support of a literal, of a connective, its share as a whole value, least shares and counts of attested fragments."""

    literal: int = 200
    connective: int = 200
    whole_ratio: float = 0.02
    attestation: float = 0.5
    fragments: int = 10
    support: int = 200
    rounds: int = 3


def separator_candidates(values: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """group, separator, records, n_values, kind, reason (why it isn't admitted, else null) of values (group, data_source, value, count, norm).

    Candidates are the literals between two runs of letters or digits, and the words within values that are hardly ever whole ones.
    """
    masked = F.regexp_replace(F.regexp_replace("value", "[A-Za-z]", "s"), "[0-9]", "d")
    pieces = F.split(masked, "[ds]+")
    between = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 2, F.lit(0))), lambda p: F.regexp_replace(p, r"\s+", " "))
    bare = F.trim("piece")
    spaced = F.when(bare.isin(*TIGHT) & (F.col("piece") != bare), F.concat(F.lit(" "), bare, F.lit(" "))).otherwise(bare)
    rows = values.select("group", "data_source", "value", "count", F.explode(between).alias("piece")).withColumn("separator", spaced)
    once = rows.where(~F.col("separator").rlike(r"[\p{L}\p{N}]")).groupBy("group", "data_source", "value", "separator").agg(F.max("count").alias("count"))
    literals = once.groupBy("group", "separator").agg(F.sum("count").alias("records"), F.count("*").alias("n_values")).withColumn("kind", F.when(F.col("separator") == "", "whitespace").otherwise("literal"))
    words = values.select("group", "count", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit("([a-z]{2,})")))).alias("separator"))
    words = words.groupBy("group", "separator").agg(F.sum("count").alias("records"), F.count("*").alias("n_values"))
    whole = values.groupBy("group", F.col("norm").alias("separator")).agg(F.sum("count").alias("whole"))
    connectives = words.join(whole, ["group", "separator"], "left").where((F.col("records") >= limits.connective) & (F.coalesce("whole", F.lit(0)) <= limits.whole_ratio * F.col("records")))
    both = literals.unionByName(connectives.drop("whole").withColumn("kind", F.lit("word")))
    sep = F.col("separator")
    holds = lambda marks: sum((sep.contains(m).cast("int") for m in marks), F.lit(0)) > 0
    literal = F.when(F.col("records") < limits.literal, "support").when(sep.rlike(PAIRING), "pairing mark").when(holds(BASE), "base separator").when(sep.isin(*TIGHT) | sep.contains("."), "word orthography").when(sep.contains("?"), "uncertainty mark")
    reason = F.when(F.col("kind") == "literal", literal).when(F.col("kind") == "word", F.when(~sep.isin(*WORDS), "content word")).otherwise("whitespace")
    return both.withColumn("reason", reason)


def separator_regex(separator: Column) -> Column:
    """The pattern at which a separator parts a value: words between spaces, others not between digits."""
    return F.when(separator.rlike("^[A-Za-z]+$"), F.concat(F.lit(r"\s+"), separator, F.lit(r"\s+"))).otherwise(F.concat(F.lit(r"(?<!\d)\s*\Q"), separator, F.lit(r"\E\s*(?!\d)")))


def fragments(value: Column, pattern: Column) -> Column:
    return F.filter(F.transform(F.split(value, pattern), F.trim), lambda p: p != "")


def score_separators(values: DataFrame, candidates: DataFrame, attested: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per group, source and candidate: how many records it parts, the share of attested fragments, and whether that makes it a separator."""
    gate = F.when(F.col("separator").rlike("^[A-Za-z]+$"), F.concat(F.lit(" "), "separator", F.lit(" "))).otherwise(F.col("separator"))
    met = values.join(candidates.select("group", "separator").distinct(), "group").where(F.contains("value", gate))
    met = met.withColumn("frags", fragments(F.col("value"), separator_regex(F.col("separator")))).where(F.size("frags") >= 2)
    support = met.groupBy("group", "data_source", "separator").agg(F.sum("count").alias("support_records"), F.sum(F.size("frags") * F.col("count")).alias("frags_total"))
    parts = met.select("group", "data_source", "separator", "count", F.explode("frags").alias("frag")).withColumn("norm", norm_term(F.col("frag")))
    known = parts.join(attested.select("group", "norm").distinct(), ["group", "norm"]).groupBy("group", "data_source", "separator").agg(F.sum("count").alias("frags_attested"), F.countDistinct("norm").alias("n_fragments"))
    rows = support.join(known, ["group", "data_source", "separator"], "left").fillna(0, ["frags_attested", "n_fragments"])
    rows = rows.withColumn("attestation", F.col("frags_attested") / F.col("frags_total"))
    return rows.withColumn("is_separator", (F.col("attestation") >= limits.attestation) & (F.col("n_fragments") >= limits.fragments) & (F.col("support_records") >= limits.support))


def split_on(values: DataFrame, accepted: DataFrame) -> DataFrame:
    """Values as their source's accepted separators leave them, longer ones first; a fragment keeps its value's count."""
    parts = F.array_sort(F.collect_set(F.struct((-F.length("separator")).alias("n"), separator_regex(F.col("separator")).alias("p"))))
    pattern = accepted.groupBy("group", "data_source").agg(F.array_join(F.transform(parts, lambda x: x["p"]), "|").alias("pattern"))
    own = F.when(F.col("pattern").isNull(), F.array("value")).otherwise(fragments(F.col("value"), F.col("pattern")))
    return values.select("group", "data_source", "value", "count").join(pattern, ["group", "data_source"], "left").select("group", "data_source", F.explode(own).alias("value"), "count")


def induce_separators(values: DataFrame, candidates: DataFrame, attested: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """group, data_source, separator, round of what is accepted in at most ``rounds`` rounds: two separators in one value attest neither alone.

    What is accepted is small (a row for a source and separator with enough support) and is checkpointed each round.
    """
    spark = values.sparkSession
    accepted = spark.createDataFrame([], "group string, data_source string, separator string, round int")
    for k in range(1, limits.rounds + 1):
        scores = score_separators(split_on(values, accepted), candidates, attested, limits).where("is_separator")
        new = scores.select("group", "data_source", "separator").join(accepted, ["group", "data_source", "separator"], "left_anti")
        rows = [(*r, k) for r in new.toLocalIterator()]
        if not rows:
            break
        accepted = accepted.unionAll(spark.createDataFrame(rows, accepted.schema))
    return accepted


def merged_patterns(values: DataFrame, dated: Sequence[str] = (), split_at: int = 50, wide: int = 3) -> DataFrame:
    """merge_group, value, merged_pattern of the distinct values: the pattern of its skeleton, with the widths that occur.

    A skeleton is split by the digit slot whose medians differ most between patterns, where they do by ``split_at`` or more: patterns of
    one slot width are put in order by their medians and cut at the widest gap. Groups in ``dated`` are also told apart by which runs are wide.
    """
    own = values.select("merge_group", "value").distinct()
    masked = F.regexp_replace(F.regexp_replace("value", "[A-Za-z]", "s"), "[0-9]", "d")
    mark = lambda r: F.substring(r, 1, 1).isin("d", "s")
    rows = own.withColumn("runs", F.regexp_extract_all(masked, F.lit(r"(d+|s+|[\s\S])")))
    rows = rows.withColumn("pattern", F.array_join(F.transform("runs", lambda r: F.when(mark(r), F.concat(F.substring(r, 1, 1), F.lit("{"), F.length(r), F.lit("}"))).otherwise(r)), ""))
    widths = F.array_join(F.transform("runs", lambda r: F.when(~mark(r), ".").when(F.length(r) >= wide, "W").otherwise("N")), "")
    alone = (F.size("runs") == 1) & mark(F.get("runs", F.lit(0)))
    key = F.regexp_replace("pattern", r"\{[0-9]+\}", "")
    key = F.when(F.col("merge_group").isin(*dated), F.concat(key, F.lit("\x1f"), F.when(alone, F.concat(F.lit("L"), F.length("value"))).otherwise(widths))).otherwise(key)
    rows = rows.withColumn("key", key)
    of = ["merge_group", "key"]
    slots = rows.select(*of, "pattern", F.posexplode(F.regexp_extract_all("value", F.lit("([0-9]+)"))).alias("slot", "digits"))
    medians = slots.groupBy(*of, "slot", F.length("digits").alias("slot_len"), "pattern").agg(F.median(F.col("digits").try_cast("bigint")).alias("median"))
    spread = medians.groupBy(*of, "slot", "slot_len").agg((F.max("median") - F.min("median")).alias("spread")).groupBy(*of, "slot").agg(F.max("spread").alias("score"))
    worst = spread.groupBy(*of).agg(F.max("score").alias("score"), F.max(F.struct("score", -F.col("slot"))).alias("top")).where(F.col("score") >= split_at).select(*of, (-F.col("top")["col2"]).alias("slot"))
    line = Window.partitionBy(*of, "slot_len").orderBy("median", "pattern")
    gaps = medians.join(worst, [*of, "slot"]).withColumn("gap", F.col("median") - F.lag("median").over(line))
    breaks = gaps.withColumn("cut", F.coalesce((F.col("gap") == F.max("gap").over(Window.partitionBy(*of, "slot_len"))).cast("int"), F.lit(0)))
    split = breaks.select(*of, "pattern", F.concat_ws(":", "slot_len", F.sum("cut").over(line)).alias("split"))
    rows = rows.join(split, [*of, "pattern"], "left").withColumn("split", F.coalesce("split", F.lit("")))
    refined = [*of, "split"]
    runs = rows.groupBy(*refined, "pattern").agg(F.first("runs").alias("runs")).select(*refined, F.posexplode("runs").alias("at", "run"))
    tokens = runs.groupBy(*refined, "at").agg(F.min(F.substring("run", 1, 1)).alias("c"), F.min(F.length("run")).alias("low"), F.max(F.length("run")).alias("high"))
    token = F.when(~mark(F.col("c")), F.col("c")).when(F.col("low") == F.col("high"), F.concat("c", F.lit("{"), "low", F.lit("}"))).otherwise(F.concat("c", F.lit("{"), "low", F.lit(","), "high", F.lit("}")))
    merged = tokens.groupBy(*refined).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", token.alias("t")))), lambda x: x["t"]), "").alias("merged_pattern"))
    return rows.join(merged, refined).select("merge_group", "value", "merged_pattern")
