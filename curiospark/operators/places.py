"""Place names: routes, orientations of their segments, spelling variants and the terms that these find."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_term

# Words that spoil a name, spelled-out abbreviations, ranks of terms, and the most segments.
SPOILED = r"[\d\[\]{}?]|\b(near|nr|probably|possibly|perhaps|presumably|formerly|vicinity|between|off|or)\b"
SPELLED = {"st": "saint"}
KINDS = {"prefLabelGVP": 0, "prefLabel": 1, "altLabel": 2}
MOST_SEGMENTS = 6
BRACKETS = r"^(.+?) ?\((.+)\)$"


def place_route(norm: Column, markers: Sequence[str]) -> Column:
    """semantic_marker (it says something of an unknown place), residue (doubt or figures in it), hierarchical (several places), or simple."""
    several = norm.rlike("[,>:]") | norm.rlike(BRACKETS)
    return F.when(norm.isin(*markers), "semantic_marker").when(norm.rlike("(?i)" + SPOILED), "residue").when(several, "hierarchical").otherwise("simple")


def _parts(text: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(text, r"\s*[>:]\s*", ", "), ","), lambda x: F.btrim(x))


def orientations(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(norm, orientation, head, context, qualifier; norms that can't be read) of hierarchical values (norm, atom).

    Listed places are read from both ends, as either may be the smallest; bracketed ones name it before the bracket. More than
    MOST_SEGMENTS parts, empty ones, or a norm that falls into other parts than the atom can't be read.
    """
    rows = values.select("norm", "atom", _parts(F.col("norm")).alias("parts"), _parts(F.col("atom")).alias("written"))
    listed = rows.where(F.size("parts") > 1)
    odd = (F.size("parts") > MOST_SEGMENTS) | F.array_contains("parts", "") | (F.size("parts") != F.size("written"))
    n = F.size("parts")
    whole = F.regexp_replace("atom", r"\s*[>:]\s*", ", ")
    ends = F.array(
        F.struct(F.lit("first").alias("orientation"), F.element_at("parts", 1).alias("head"), F.slice("parts", F.lit(2), n - 1).alias("context"), F.regexp_replace(whole, r"^[^,]*,\s*", "").alias("qualifier")),
        F.struct(F.lit("last").alias("orientation"), F.element_at("parts", -1).alias("head"), F.slice("parts", F.lit(1), n - 1).alias("context"), F.regexp_replace(whole, r"\s*,[^,]*$", "").alias("qualifier")),
    )
    from_list = listed.where(~odd).select("norm", F.explode(ends).alias("e")).select("norm", "e.*")
    before, inside = norm_term(F.regexp_extract("norm", BRACKETS, 1)), F.regexp_extract("norm", BRACKETS, 2)
    bracketed = rows.where((F.size("parts") == 1) & F.col("norm").rlike(BRACKETS)).where(before != "")
    own = bracketed.select("norm", F.lit("paren").alias("orientation"), before.alias("head"), F.array(norm_term(inside)).alias("context"), F.nullif(F.regexp_extract("atom", BRACKETS, 2), F.lit("")).alias("qualifier"))
    return from_list.unionAll(own), listed.where(odd).select("norm")


def spellings(norm: Column) -> Column:
    """Other spellings, the closest first: without stops, then with abbreviations spelled out; none of a null."""
    plain = F.btrim(F.regexp_replace(F.replace(norm, F.lit("."), F.lit(" ")), r"\s+", " "))

    def spelled(text: Column) -> Column:
        word = lambda w: F.coalesce(*(F.when(w == k, v) for k, v in SPELLED.items()), w)
        return F.array_join(F.transform(F.split(text, " "), word), " ")

    return F.filter(F.array_distinct(F.array(plain, spelled(norm), spelled(plain))), lambda v: (v != norm) & (v != ""))


def head_terms(index: DataFrame, heads: DataFrame) -> DataFrame:
    """Per (head, subject): the term of the index (norm, subject, kind, term, lang) that a head or a spelling of it finds.

    The head itself goes before its spellings, in their order; then the kind of the term and English ones. The forms of the
    heads meet the index in one join on the form, and one aggregate picks the winner: no sort.
    """
    forms = heads.select("head").distinct().select("head", F.posexplode(F.concat(F.array("head"), spellings(F.col("head")))).alias("way", "norm"))
    kind = F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in KINDS.items()))
    found = forms.join(index.where(kind.isNotNull()).select("norm", "subject", kind.alias("rank"), F.coalesce((~F.col("lang").startswith("en")).cast("int"), F.lit(1)).alias("foreign"), "term"), "norm")
    best = found.groupBy("head", "subject").agg(F.min(F.struct("way", "rank", "foreign", "term")).alias("best"))
    return best.select("head", "subject", (F.col("best.way") > 0).alias("by_spelling"), F.col("best.rank").alias("rank"), F.col("best.term").alias("term"))
