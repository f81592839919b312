"""Cleaning of recorded values, as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import norm_term

# Entities, what separates values, what stands for no value.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))
SEPARATORS = " ,;:|/-"
NOTHING = ("unknown", "n/a", "na", "none", "not known", "not recorded", "null", "tbc", "untitled", "-", "?")


def unescape(text: Column) -> Column:
    for name, value in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(value))
    return text


def plain(text: Column) -> Column:
    """Markup as text: comments go, breaks and block ends become newlines, other tags nothing; single spaces."""
    text = F.regexp_replace(text, r"<!--[\s\S]*?-->", "")
    text = F.regexp_replace(text, r"(?i)<br[^<>]*>|</(p|div|li|tr|h[1-6])>", "\n")
    text = unescape(F.regexp_replace(text, "<[A-Za-z/!][^<>]*>", ""))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t\r]+", " "), r" ?\n[ \n]*", "\n")
    return F.btrim(text, F.lit(" \n"))


def strip_separators(text: Column) -> Column:
    return F.btrim(text, F.lit(SEPARATORS))


def is_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def says_nothing(text: Column) -> Column:
    """A placeholder, or a label or unit that nothing follows."""
    norm = norm_term(text)
    return F.coalesce(norm.isin(*NOTHING) | text.rlike(r"^[A-Za-z ]{1,30}:$") | norm.isin("mm", "cm", "in", "kg", "g"), F.lit(False))


def echoes(text: Column, field: Column) -> Column:
    """Whether the value only names its own field."""
    return F.coalesce(norm_term(text) == norm_term(F.translate(F.substring_index(field, "/", -1), "_", " ")), F.lit(False))


# What a query string looks like, where a mark stands for the whole value, and the limits of prose.
LINKED = r"https?://|www\.|\?[\w.%+-]+=|&[\w.%+-]+="
AT_AN_EDGE = r"[^?]\?+\s*$|^\s*\?+[^?]"
PROSE_TOKENS, PROSE_SHARE = 5, 0.05


def join_share(text: Column, joining: Sequence[str]) -> Column:
    """The share of a value's words that only join others; 0 below PROSE_TOKENS words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    share = F.size(F.filter(words, lambda w: w.isin(*joining))) / F.size(words)
    return F.when(F.size(words) >= PROSE_TOKENS, share).otherwise(0.0)


def question_use(text: Column, joining: Sequence[str]) -> Column:
    """link, sentence (joining words make it prose), mid_value (no edge has the mark) or doubt: what a question mark is for; null without one."""
    use = F.when(text.rlike(LINKED), "link").when(join_share(text, joining) > PROSE_SHARE, "sentence").when(~text.rlike(AT_AN_EDGE), "mid_value").otherwise("doubt")
    return F.when(text.contains("?"), use)
