"""US location parsing.

Two layers:

* column functions (``is_remote``, ``extract_state_code``, ``extract_city``,
  ``extract_postal_code``) for ad-hoc use;
* ``with_location(df, col)``, the DataFrame form used by the pipeline. It
  computes the stripped text and the state once, as their own columns, and
  yields all parsed fields from them as one struct per row through ``inline``.
  A generator's output is no expression that the optimizer could copy into a
  filter or a later projection, so however often the fields are used, every
  row is parsed once and predicates on them stay small.

Long keyword lists (51 state names) are matched with one higher-order
``filter`` over a literal array instead of 51 unrolled branches, which keeps
the generated code small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries import (
    CONF_LENIENT, CONF_STATE, CONF_US_PHRASE, REMOTE_KEYWORDS,
    STRICT_MIN_CONFIDENCE, US_PHRASES, US_STATES,
)
from .patterns import AFTER, BEFORE, DIGIT, WS
from .text import _col, strip_ws

STATE_CODES = tuple(code for code, _ in US_STATES)

# A state code followed (optionally by a ZIP and) by a comma or the end.
STATE_CODE_PATTERN = (
    "(?d)" + BEFORE + "(" + "|".join(STATE_CODES) + ")"
    + "(?:" + WS + "+" + DIGIT + "{5})?(?:" + WS + "*,|" + WS + "*$)"
)
POSTAL_PATTERN = BEFORE + "(" + DIGIT + "{5})" + AFTER
CITY_PREFIX_PATTERN = "(?iu)^(?:Greater|Metro)" + WS + "+"
CITY_HEAD = "(?iud)^(.+?)," + WS + "*"


def _contains_any(lowered: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])


def _state_names() -> Column:
    return F.array(*[F.struct(F.lit(n.lower()).alias("name"), F.lit(c).alias("code")) for c, n in US_STATES])


def is_remote(c: Column | str) -> Column:
    """True when the lower-cased text contains any remote keyword."""
    return F.coalesce(_contains_any(F.lower(_col(c)), REMOTE_KEYWORDS), F.lit(False))


def state_by_code(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(F.upper(_col(c)), STATE_CODE_PATTERN, 1), F.lit(""))


def state_by_name(c: Column | str) -> Column:
    """First full state name (table order) contained in the lower-cased text."""
    low = F.lower(_col(c))
    hits = F.filter(_state_names(), lambda s: low.contains(s["name"]))
    return F.try_element_at(hits, F.lit(1))["code"]


def extract_state_code(c: Column | str) -> Column:
    """State code: first ``XX`` (optionally ``XX 12345``) ending a comma
    clause or the text; else the first full state name in table order."""
    return F.coalesce(state_by_code(c), state_by_name(c))


def _city_fallback(t: Column) -> Column:
    head = strip_ws(F.substring_index(t, ",", 1))
    return F.when((head != "") & ~F.upper(head).isin(*STATE_CODES), head)


def extract_city(c: Column | str, state: Column | str | None = None) -> Column:
    """City before ``, <state>`` (leading Greater/Metro dropped); else the text
    before the first comma unless that is itself a state code.

    The state varies per row, so the pattern is built per row from a fixed
    head and the code (compiled patterns are reused while the code repeats).
    """
    t = _col(c)
    fallback = _city_fallback(t)
    if state is None:
        return fallback
    st = _col(state)
    pattern = F.concat(F.lit(CITY_HEAD), st, F.lit(AFTER))
    by_state = F.nullif(F.call_function("regexp_extract", t, pattern, F.lit(1)), F.lit(""))
    cleaned = F.regexp_replace(strip_ws(by_state), CITY_PREFIX_PATTERN, "")
    return F.coalesce(cleaned, fallback)


def extract_postal_code(c: Column | str) -> Column:
    """First standalone five-digit group."""
    return F.nullif(F.regexp_extract(_col(c), POSTAL_PATTERN, 1), F.lit(""))


LOC_FIELDS = ("city", "state", "postal_code", "is_remote", "is_us", "confidence")


def with_location(df: DataFrame, col: str, strict: bool = True, prefix: str = "") -> DataFrame:
    """Add ``{prefix}city, state, postal_code, is_remote, is_us, confidence``.

    Null/empty text is never US (even when not strict). A state makes it US
    at 0.9 with city and ZIP; otherwise a US phrase gives 0.7; otherwise not
    US when strict, US at 0.3 when lenient.
    """
    raw = F.col(col)
    s1 = df.withColumn("__loc_t", strip_ws(raw)).withColumn("__loc_empty", raw.isNull() | (raw == ""))
    s2 = s1.withColumn("__loc_st", F.when(~F.col("__loc_empty"), extract_state_code("__loc_t")))
    t, st, empty = F.col("__loc_t"), F.col("__loc_st"), F.col("__loc_empty")
    has_state = st.isNotNull()
    phrase = _contains_any(F.lower(t), US_PHRASES)
    fallback_us = F.lit(not strict)
    is_us = F.when(empty, False).when(has_state, True).when(phrase, True).otherwise(fallback_us)
    conf = (F.when(empty, 0.0).when(has_state, CONF_STATE).when(phrase, CONF_US_PHRASE)
            .otherwise(0.0 if strict else CONF_LENIENT))
    s3 = s2.select("*", F.inline(F.array(F.struct(
        F.when(has_state, extract_city(t, st)).alias(prefix + "city"),
        st.alias(prefix + "state"),
        F.when(has_state, extract_postal_code(t)).alias(prefix + "postal_code"),
        F.when(empty, False).otherwise(is_remote(t)).alias(prefix + "is_remote"),
        is_us.alias(prefix + "is_us"),
        conf.cast("double").alias(prefix + "confidence"),
    ))))
    return s3.drop("__loc_t", "__loc_empty", "__loc_st")


def parse_us_location(c: Column | str, strict: bool = True) -> Column:
    """Column form of ``with_location`` returning a struct (evaluates the
    state once per field; prefer ``with_location`` on large data)."""
    raw = _col(c)
    t = strip_ws(raw)
    empty = raw.isNull() | (raw == "")
    st = F.when(~empty, extract_state_code(t))
    has_state = st.isNotNull()
    phrase = _contains_any(F.lower(t), US_PHRASES)
    is_us = F.when(empty, False).when(has_state, True).when(phrase, True).otherwise(F.lit(not strict))
    conf = (F.when(empty, 0.0).when(has_state, CONF_STATE).when(phrase, CONF_US_PHRASE)
            .otherwise(0.0 if strict else CONF_LENIENT))
    return F.struct(
        F.when(has_state, extract_city(t, st)).alias("city"),
        st.alias("state"),
        F.when(has_state, extract_postal_code(t)).alias("postal_code"),
        F.when(empty, False).otherwise(is_remote(t)).alias("is_remote"),
        is_us.alias("is_us"),
        conf.cast("double").alias("confidence"),
    )


def valid_us(is_us: Column | str, confidence: Column | str, strict: bool = True) -> Column:
    """``is_us and (not strict or confidence >= 0.7)``."""
    ok = _col(is_us)
    if strict:
        ok = ok & (_col(confidence) >= STRICT_MIN_CONFIDENCE)
    return ok


def validate_us_location(c: Column | str, strict: bool = True) -> Column:
    p = parse_us_location(c, strict)
    return valid_us(p["is_us"], p["confidence"], strict)
