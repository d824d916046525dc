"""Text functions (column expressions, evaluated inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dictionaries import US_STATES
from .keyword_scan import let
from .patterns import BEFORE, AFTER, EDGE_WS, HTML_TAG, LATIN_WS_TO_MEND, TOKEN, WIDE_WS, WS_RUN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove leading/trailing whitespace (full Unicode set, like ``str.strip``)."""
    return F.regexp_replace(_col(c), EDGE_WS, "")


def _one_space(c: Column) -> Column:
    """Every whitespace run as one space. Texts without whitespace beyond
    Latin-1 (nearly all) take a pattern of single-byte classes, and runs that
    are one space already are not touched: both are many times cheaper."""
    return F.when(c.rlike(WIDE_WS), F.regexp_replace(c, WS_RUN, " ")).otherwise(F.regexp_replace(c, LATIN_WS_TO_MEND, " "))


def normalize_whitespace(c: Column | str) -> Column:
    """Collapse every whitespace run to one space and trim; null -> ''."""
    return F.coalesce(F.trim(_one_space(_col(c))), F.lit(""))


def clean_text(c: Column | str, lowercase: bool = False) -> Column:
    """Replace HTML tags by a space, normalise whitespace, optionally lower.

    Entities are not decoded and script bodies are kept, as in the original.
    """
    text = _col(c)
    no_tags = F.when(text.contains("<"), F.regexp_replace(text, HTML_TAG, " ")).otherwise(text)
    out = F.trim(let(no_tags, _one_space))
    if lowercase:
        out = F.lower(out)
    return F.coalesce(out, F.lit(""))


def extract_keywords(c: Column | str, min_length: int = 3) -> Column:
    """Lower-cased word tokens (letters, digits, _ and inner hyphens) of at
    least ``min_length`` characters, in order, repeats kept."""
    toks = F.regexp_extract_all(clean_text(c, lowercase=True), F.lit(TOKEN), 0)
    return F.filter(toks, lambda t: F.length(t) >= min_length)


def extract_state_abbrev(c: Column | str) -> Column:
    """First two-letter word of the upper-cased text that is a state code."""
    codes = "|".join(code for code, _ in US_STATES)
    pattern = "(?d)" + BEFORE + "(" + codes + ")" + AFTER
    return F.nullif(F.regexp_extract(F.upper(_col(c)), pattern, 1), F.lit(""))
