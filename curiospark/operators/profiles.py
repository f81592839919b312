"""Profiles of a node table: importance of fields, vocabularies, text statistics, trees, patterns, placement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .metrics import KEYS, information_content, value_frequencies
from .ranked import head_size, nearest_quantile

CELL = ["data_source", "field_type"]


def importance_weights(nodes: DataFrame) -> DataFrame:
    """Mean over all sources of the share of records that fill a field; sources without it count as 0."""
    totals = nodes.groupBy("data_source").agg(F.countDistinct("record_id").alias("total"))
    sources = totals.agg(F.count("*").alias("sources"))
    filled = nodes.where(F.col("value").isNotNull()).groupBy(*CELL).agg(F.countDistinct("record_id").alias("n"))
    shares = filled.join(totals, "data_source").groupBy("field_type").agg(F.sum(F.col("n") / F.col("total")).alias("s"))
    return shares.join(F.broadcast(sources)).select("field_type", (F.col("s") / F.col("sources")).alias("w"))


def completeness_ratios(nodes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Share of the standard's fields that a record fills, plain and by importance."""
    weights = importance_weights(nodes).where(F.col("field_type").isin(*fields))
    total = weights.agg(F.sum("w").alias("total"))
    filled = nodes.where(F.col("value").isNotNull() & F.col("field_type").isin(*fields)).select(*KEYS, "field_type").distinct()
    sums = filled.join(weights, "field_type", "left").groupBy(*KEYS).agg(F.count("*").alias("n"), F.sum(F.coalesce("w", F.lit(0.0))).alias("s"))
    return sums.join(F.broadcast(total)).select(*KEYS, (F.col("n") / len(fields)).alias("ratio"), (F.col("s") / F.col("total")).alias("weighted"))


def provenance(scores: DataFrame, column: str) -> DataFrame:
    return scores.groupBy("data_source").agg(F.avg(column).alias("provenance"), F.count("*").alias("n_records"))


def field_frequency_profile(nodes: DataFrame) -> DataFrame:
    """Each source's fields by falling share of its values (ties by name), with cumulative shares."""
    counts = nodes.where(F.col("value").isNotNull()).groupBy(*CELL).agg(F.count("*").alias("occurrences"))
    own = Window.partitionBy("data_source")
    order = own.orderBy(F.desc("occurrences"), "field_type")
    total = F.sum("occurrences").over(own)
    running = F.sum("occurrences").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return counts.select("*", (F.col("occurrences") / total).alias("share"), (running / total).alias("cum_share"), F.row_number().over(order).alias("rank"))


def pareto_summary(profile: DataFrame) -> DataFrame:
    """How few fields carry half and four fifths of a source's values, and the share of its top fifth of fields."""
    n = profile.withColumn("n", F.count("*").over(Window.partitionBy("data_source")))
    reach = lambda q: F.least(F.sum((F.col("cum_share") < q).cast("long")) + 1, F.count("*"))
    top = F.sum(F.when(F.col("rank") <= F.ceil(F.col("n") / 5), F.col("share")).otherwise(0.0))
    return n.groupBy("data_source").agg(F.count("*").alias("n_fields"), reach(0.5).alias("k_50"), reach(0.8).alias("k_80"), top.alias("top_fifth_share"))


def field_vocabulary(nodes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Occurrences, distinct values, share of single ones, size of the head that covers 80 %, mean information content."""
    frequencies = value_frequencies(nodes, fields)
    both = frequencies.join(information_content(frequencies), ["field_type", "value"])
    sums = both.groupBy("field_type").agg(
        F.sum("times").alias("n_occurrences"), F.count("*").alias("n_distinct"), F.avg((F.col("times") == 1).cast("int")).alias("singleton_rate"),
        F.avg("ic").alias("mean_ic"), (F.sum(F.col("ic") * F.col("times")) / F.sum("times")).alias("mean_ic_weighted"),
    )
    return sums.join(head_size(frequencies, ["field_type"], "times"), "field_type")


def fragmentation(nodes: DataFrame, fields: Sequence[str], least: int = 1) -> DataFrame:
    """For each source and field: how many ways it writes its values, and how few of them carry most."""
    counts = nodes.where(F.col("field_type").isin(*fields) & F.col("value").isNotNull()).groupBy(*CELL, T.norm_term(F.col("value")).alias("norm")).agg(F.count("*").alias("occ"))
    sums = counts.groupBy(*CELL).agg(F.count("*").alias("n_terms"), F.sum("occ").alias("n_occurrences"), F.avg((F.col("occ") == 1).cast("int")).alias("singleton_rate"))
    ratio = F.when(F.col("n_occurrences") > 1, F.ln("n_terms") / F.ln("n_occurrences"))
    return sums.where(F.col("n_occurrences") >= least).join(head_size(counts, CELL, "occ"), CELL).withColumn("fragmentation", ratio)


def term_weights(texts: DataFrame, keys: Sequence[str], least: int = 3, most: int = 50_000) -> DataFrame:
    """Smoothed inverse document frequency of the most frequent words; a document is a distinct key with text."""
    documents = texts.where(F.length("value") > 0)
    n = documents.select(*keys).distinct().agg(F.count("*").alias("n_docs"))
    tf = documents.select(*keys, F.explode(T.words(F.col("value"))).alias("token")).groupBy(*keys, "token").agg(F.count("*").alias("tf"))
    df = tf.groupBy("token").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= least)
    kept = df.orderBy(F.desc("total"), "token").limit(most)
    return kept.join(F.broadcast(n)).select("token", "df", "total", (F.ln((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf"))


def coherence(texts: DataFrame, least: int = 3) -> DataFrame:
    """Mean cosine distance between the texts of a record's fields, of records with two or more.

    The products of all pairs come from sums by word: the square of the sum less the sum of squares, halved.
    """
    texts = texts.where(F.length("value") > 0)
    several = texts.groupBy("record_id").agg(F.countDistinct("field_type").alias("n_docs")).where("n_docs >= 2")
    own = texts.join(several.select("record_id"), "record_id", "left_semi")
    doc = ["record_id", "field_type"]
    tf = own.select(*doc, F.explode(T.words(F.col("value"))).alias("token")).groupBy(*doc, "token").agg(F.count("*").alias("tf"))
    # At most ``most`` words, so that no word is one key of a shuffle.
    w = tf.join(F.broadcast(term_weights(texts, doc, least).select("token", "idf")), "token").withColumn("w", (1 + F.ln("tf")) * F.col("idf"))
    norms = w.groupBy(*doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = w.join(norms, doc).withColumn("w", F.col("w") / F.col("norm"))
    shared = unit.groupBy("record_id", "token").agg(F.sum("w").alias("s"), F.sum(F.col("w") * F.col("w")).alias("q"))
    pairs = shared.groupBy("record_id").agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2).alias("similarity"))
    mean = F.coalesce("similarity", F.lit(0.0)) / (F.col("n_docs") * (F.col("n_docs") - 1) / 2)
    return several.join(pairs, "record_id", "left").select("record_id", "n_docs", F.least(F.greatest(1 - mean, F.lit(0.0)), F.lit(1.0)).alias("coherence"))


def thinness(nodes: DataFrame, free: Sequence[str], least: int = 50) -> DataFrame:
    """Characters against the source's 90th percentile, the share of free text, and what is left unstructured."""
    size = F.coalesce(F.length("value"), F.lit(0)).cast("long")
    chars = nodes.groupBy(*KEYS).agg(F.sum(size).alias("c_total"), F.sum(F.when(F.col("field_type").isin(*free), size).otherwise(0)).alias("c_free"))
    q90 = nearest_quantile(chars, ["data_source"], "c_total", 9, "q90")
    density = F.when(F.col("q90") > 0, F.least(F.col("c_total") / F.col("q90"), F.lit(1.0)))
    both = chars.join(q90, "data_source").withColumn("density", density).withColumn("skew", F.when(F.col("c_total") >= least, F.col("c_free") / F.col("c_total")))
    return both.select(*KEYS, "c_total", "density", "skew", (1 - F.col("density") * (1 - F.coalesce("skew", F.lit(0.0)))).alias("thinness"))


def fragments(tree: DataFrame) -> DataFrame:
    """Roots that have a value or children, with whether they have children (``decomposed``)."""
    parents = tree.where("depth = 1").select(F.col("parent_id").alias("node_id")).distinct().withColumn("has", F.lit(1))
    roots = tree.where("depth = 0").join(parents, "node_id", "left").withColumn("decomposed", F.coalesce("has", F.lit(0)))
    return roots.where(F.col("value").isNotNull() | (F.col("decomposed") == 1)).drop("has")


def decomposition_cells(tree: DataFrame) -> DataFrame:
    return fragments(tree).groupBy(*CELL).agg(F.count("*").alias("fragments"), F.avg("decomposed").alias("decomposed"))


def decomposition(tree: DataFrame) -> DataFrame:
    """A record's decomposed fragments weighted by how often their field is, and its children for each parent."""
    own = fragments(tree)
    propensity = own.groupBy("field_type").agg(F.avg("decomposed").alias("p"))
    sums = own.join(propensity, "field_type").groupBy(*KEYS).agg(F.sum(F.col("p") * F.col("decomposed")).alias("num"), F.sum("p").alias("den"))
    depth = tree.where("depth = 1").groupBy(*KEYS).agg((F.count("*") / F.countDistinct("parent_id")).alias("decomposition_depth"))
    rate = F.when(F.col("den") > 0, F.col("num") / F.col("den"))
    return sums.join(depth, KEYS, "left").select(*KEYS, rate.alias("decomposition_rate"), "decomposition_depth")


def pattern_counts(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("value").isNotNull()).groupBy(*CELL, T.signature(F.col("value")).alias("pattern")).agg(F.count("*").alias("n"))


def pattern_widths(nodes: DataFrame) -> DataFrame:
    """For each skeleton of a field: how many values, and the shortest and longest of each run."""
    lengths = F.transform(T.runs(F.col("value")), F.length)
    shapes = nodes.where(F.col("value").isNotNull()).groupBy("field_type", T.skeleton(F.col("value")).alias("skeleton"), lengths.alias("lengths")).agg(F.count("*").alias("n"))
    runs = shapes.select("field_type", "skeleton", "n", F.posexplode("lengths").alias("run", "length"))
    return runs.groupBy("field_type", "skeleton", "run").agg(F.sum("n").alias("n"), F.min("length").alias("shortest"), F.max("length").alias("longest"))


def pattern_concentration(nodes: DataFrame, head: float = 0.05) -> DataFrame:
    """For each source and field: patterns, those with at least ``head`` of the values, their share, and k_80."""
    counts = pattern_counts(nodes).withColumn("total", F.sum("n").over(Window.partitionBy(*CELL)))
    in_head = F.col("n") / F.col("total") >= head
    sums = counts.groupBy(*CELL).agg(
        F.count("*").alias("n_patterns"), F.sum(in_head.cast("long")).alias("n_head_patterns"), F.sum("n").alias("n_records"),
        (F.sum(F.when(in_head, F.col("n")).otherwise(0)) / F.sum("n")).alias("head_share"),
    )
    return sums.join(head_size(counts, CELL, "n"), CELL)


def head_floors(nodes: DataFrame, floors: Sequence[float]) -> DataFrame:
    """For each source, field and floor of a head pattern's share: values, those in head patterns, head patterns, and the share outside."""
    counts = pattern_counts(nodes).withColumn("total", F.sum("n").over(Window.partitionBy(*CELL)))
    rows = counts.withColumn("head_floor", F.explode(F.array(*map(F.lit, floors)))).withColumn("inside", F.col("n") / F.col("total") >= F.col("head_floor"))
    sums = rows.groupBy(*CELL, "head_floor").agg(F.sum("n").alias("n_values"), F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("head_count"), F.count_if("inside").alias("n_head_patterns"))
    return sums.withColumn("divergent_share", 1 - F.col("head_count") / F.col("n_values"))


def pattern_consistency(nodes: DataFrame, head: float = 0.05) -> DataFrame:
    """Share of a record's values whose pattern is a head pattern of its source and field."""
    counts = pattern_counts(nodes).withColumn("total", F.sum("n").over(Window.partitionBy(*CELL)))
    heads = counts.where(F.col("n") / F.col("total") >= head).select(*CELL, "pattern", F.lit(1).alias("ok"))
    own = nodes.where(F.col("value").isNotNull()).withColumn("pattern", T.signature(F.col("value")))
    sums = own.join(heads, [*CELL, "pattern"], "left").groupBy(*KEYS).agg(F.count("*").alias("applicable"), F.count("ok").alias("conventional"))
    return sums.withColumn("consistency", F.col("conventional") / F.col("applicable"))


def consensus_home(nodes: DataFrame, least: int = 2, dominance: float = 0.5) -> DataFrame:
    """Values that a source keeps in another field than most sources do, with that field."""
    usage = nodes.where(F.col("value").isNotNull()).select(*CELL, T.norm_term(F.col("value")).alias("norm")).distinct()
    support = usage.groupBy("norm", F.col("field_type").alias("field")).agg(F.count("*").alias("sources"))
    support = support.withColumn("homes", F.count("*").over(Window.partitionBy("norm"))).where("homes > 1").drop("homes")
    others = usage.join(support, "norm").withColumn("sources", F.col("sources") - (F.col("field_type") == F.col("field")).cast("long"))
    found = others.groupBy("data_source", "norm", "field_type").agg(
        F.min_by("field", F.struct(-F.col("sources"), F.col("field"))).alias("home_field"), F.max("sources").alias("home_sources"), F.sum("sources").alias("all_sources")
    )
    return found.where((F.col("home_field") != F.col("field_type")) & (F.col("home_sources") >= least) & (F.col("home_sources") / F.col("all_sources") >= dominance))


def conflation(nodes: DataFrame) -> DataFrame:
    """How much of a source's smaller field vocabulary its other field shares, of fields that share a term."""
    terms = nodes.where(F.col("value").isNotNull()).select(*CELL, T.norm_term(F.col("value")).alias("norm")).distinct()
    sizes = terms.groupBy(*CELL).agg(F.count("*").alias("n"))
    pairs = terms.select("data_source", "norm", F.col("field_type").alias("field_a")).join(terms.select("data_source", "norm", F.col("field_type").alias("field_b")), ["data_source", "norm"])
    shared = pairs.where("field_a < field_b").groupBy("data_source", "field_a", "field_b").agg(F.count("*").alias("shared"))
    for side in "ab":
        shared = shared.join(sizes.select("data_source", F.col("field_type").alias(f"field_{side}"), F.col("n").alias(f"n_{side}")), ["data_source", f"field_{side}"])
    return shared.withColumn("overlap", F.col("shared") / F.least("n_a", "n_b"))


def divergence(nodes: DataFrame, field: str) -> DataFrame:
    """Jensen-Shannon distance (base 2) of the value distributions of sources that share a value.

    Only shared values are joined; what either source has alone adds half of its mass.
    """
    counts = nodes.where((F.col("field_type") == field) & F.col("value").isNotNull()).groupBy("data_source", "value").agg(F.count("*").alias("n"))
    shares = counts.select("data_source", "value", (F.col("n") / F.sum("n").over(Window.partitionBy("data_source"))).alias("p"))
    both = shares.toDF("source_a", "value", "p").join(shares.toDF("source_b", "value", "q"), "value").where("source_a < source_b")
    m = (F.col("p") + F.col("q")) / 2
    part = F.col("p") * F.log2(F.col("p") / m) + F.col("q") * F.log2(F.col("q") / m)
    sums = both.groupBy("source_a", "source_b").agg(F.sum(part).alias("d"), F.sum(F.col("p") + F.col("q")).alias("mass"))
    squared = (F.col("d") + 2 - F.col("mass")) / 2
    return sums.select("source_a", "source_b", F.sqrt(F.greatest(squared, F.lit(0.0))).alias("distance"))


def variance_share(rows: DataFrame, group: str, measure: str) -> DataFrame:
    """Share of a measure's variance that lies between groups."""
    sums = rows.where(F.col(measure).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(measure).alias("mean"), F.var_pop(measure).alias("v"))
    both = sums.withColumn("grand", F.sum(F.col("n") * F.col("mean")).over(Window.partitionBy()) / F.sum("n").over(Window.partitionBy()))
    between = F.sum(F.col("n") * (F.col("mean") - F.col("grand")) * (F.col("mean") - F.col("grand")))
    within = F.sum(F.col("n") * F.col("v"))
    return both.agg(F.count("*").alias("groups"), F.when(between + within > 0, between / (between + within)).alias("share"))
