"""Nested catalogue records from lines of JSON, N-Triples, and the newest copy of each record."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lexer import column_parser
from ..functions.text import norm_term

LEVELS = 4


def unit_type(levels: int = LEVELS) -> str:
    """A unit and those below it; what lies deeper than the last level stays JSON text."""
    below = "string" if levels == 1 else f"array<{unit_type(levels - 1)}>"
    return f"struct<label: string, path: string, type: string, value: string, extra: string, units: {below}>"


RECORD_TYPE = f"struct<`@admin`: struct<uuid: string, uid: string, processed: bigint, data_source: struct<code: string, name: string>>, `@document`: struct<type: string, units: array<{unit_type()}>>>"


# The keys that a record, its administration, its source and its document may have.
KEYS = {"": ("@admin", "@document"), "@admin.": ("added", "data_source", "id", "processed", "sequence", "source", "stream", "uid", "uuid"), "@admin.data_source.": ("code", "group", "name", "organisation"), "@document.": ("type", "units")}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON lines (compressed or not), with the place of each line in the export; broken lines give nulls.

    The place is the file and the line's number within the task that read it, so lines of one file keep their order.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("ordinal"))
    return parse_records(lines, "file", "ordinal")


def parse_records(lines: DataFrame, *more: str) -> DataFrame:
    """Records of a column ``value`` of JSON, and the columns ``more``."""
    admin = F.col("r.`@admin`")
    return lines.select(*more, F.from_json("value", RECORD_TYPE).alias("r"), spilled(F.col("value")).alias("extra")).select(
        *more, admin["uuid"].alias("record_id"), admin["data_source"]["name"].alias("data_source"),
        F.timestamp_millis(admin["processed"]).alias("processed"), F.col("r.`@document`.units").alias("units"), "extra",
    )


def spilled(line: Column) -> Column:
    """What a record carries under keys that it shouldn't have, as JSON under dotted keys; null if nothing."""
    whole = F.from_json(line, "map<string,string>")
    inner = lambda m, k: F.from_json(F.try_element_at(m, F.lit(k)), "map<string,string>")
    admin = inner(whole, "@admin")
    found = F.create_map().cast("map<string,string>")
    for prefix, part in (("", whole), ("@admin.", admin), ("@admin.data_source.", inner(admin, "data_source")), ("@document.", inner(whole, "@document"))):
        unknown = F.map_filter(part, lambda k, _: ~k.isin(*KEYS[prefix]))
        named = F.transform_keys(unknown, lambda k, _: F.concat(F.lit(prefix), k))
        found = F.map_concat(found, F.coalesce(named, F.create_map().cast("map<string,string>")))
    return F.when(F.size(found) > 0, F.to_json(found))


def newest(records: DataFrame, key: str, *order: str) -> DataFrame:
    """The copy of each key that comes last in ``order``; an aggregate, so it also runs on a stream."""
    last = F.max_by(F.struct(*records.columns), F.struct(*order)).alias("last")
    return records.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(last).select("last.*")


def _tree(units: Column, place: Column, parent: Column, depth: int) -> Column:
    def own(unit: Column, at: Column) -> Column:
        here = F.concat(place, F.lit("/"), at.cast("string"))
        deeper = unit["units"] if depth == LEVELS - 1 else F.lit(None).cast("string")
        fields = [unit[c].alias(c) for c in ("label", "path", "type", "value", "extra")]
        node = F.array(F.struct(here.alias("node_id"), parent.alias("parent_id"), F.lit(depth).alias("depth"), *fields, deeper.alias("deeper")))
        return node if depth == LEVELS - 1 else F.concat(node, _tree(unit["units"], here, here, depth + 1))

    return F.coalesce(F.flatten(F.transform(units, own)), F.array().cast(_NODES))


_NODES = "array<struct<node_id: string, parent_id: string, depth: int, label: string, path: string, type: string, value: string, extra: string, deeper: string>>"


def flatten(records: DataFrame) -> DataFrame:
    """One row per unit, in one pass and without a shuffle: ids are the places of units within their record."""
    tree = _tree(F.col("units"), F.col("record_id"), F.lit(None).cast("string"), 0)
    return records.select("record_id", "data_source", F.explode(tree).alias("n")).select("record_id", "data_source", "n.*")


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return parse_triples(spark.read.text(path))


def parse_triples(lines: DataFrame) -> DataFrame:
    """Subject, predicate, and object (as written) of N-Triples in a column ``value``; other lines are left out."""
    line = r"^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(.+?)\s*\.\s*$"
    rows = lines.where(F.col("value").rlike(line))
    part = lambda n: F.regexp_extract("value", line, n)
    return rows.select(F.regexp_replace(part(1), "^<|>$", "").alias("subject"), part(2).alias("predicate"), part(3).alias("object"))


def unescaped(text: Column) -> Column:
    """A literal without its escapes, composed; only values with a backslash go through Python, each once a batch."""
    return F.when(text.contains("\\"), column_parser(_unescape, "string")(text)).otherwise(text)


def _unescape(text: str) -> str:
    # The escapes of one letter.
    plain = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}
    one = lambda m: plain[m[3]] if m[3] else chr(int(m[1] or m[2], 16))
    return unicodedata.normalize("NFC", re.sub(r"""\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|([tbnrf"'\\]))""", one, text))


def term_index(triples: DataFrame, links: Sequence[str], text: str) -> DataFrame:
    """subject, kind, term, lang, norm: terms that subjects link to by one of the predicates ``links``, with their ``text``; numbers end the ids."""
    number = lambda c: F.regexp_extract(c, r"(\d+)>?$", 1)
    linked = triples.where(F.col("predicate").isin(*links)).select(number("subject").alias("subject"), number("object").alias("term_id"), F.regexp_extract("predicate", r"[#/](\w+)$", 1).alias("kind"))
    literal = r'^"(.*)"(?:@([\w-]+))?$'
    terms = triples.where(F.col("predicate") == text).select(number("subject").alias("term_id"), unescaped(F.regexp_extract("object", literal, 1)).alias("term"), F.nullif(F.regexp_extract("object", literal, 2), F.lit("")).alias("lang"))
    return linked.join(terms, "term_id").select("subject", "kind", "term", "lang", norm_term(F.col("term")).alias("norm")).where("norm <> ''").distinct()
