"""Regex building blocks.

Spark evaluates regexes with java.util.regex. The behaviour being rebuilt was
defined with Unicode-aware word boundaries and whitespace, so the classes are
spelled out explicitly instead of relying on ``\\b``/``\\s`` (which are ASCII in
Java unless flagged, and differ again between engines):

* ``WORD``  - a word character: any letter, any number, or underscore.
* ``WS``    - a whitespace character: the Unicode White_Space set plus the
  four ASCII separators U+001C..U+001F that Python's ``str.split`` treats as
  whitespace.

Boundaries are written as look-arounds on ``WORD`` so they mean exactly
"previous/next character is not a word character".
"""

from __future__ import annotations

import re

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
WS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
DIGIT = r"\p{Nd}"

HTML_TAG = r"<[^>]+>"
WS_RUN = WS + "+"
# The same set in two parts: beyond Latin-1 (a range that holds all of it), and
# within; there, runs that are not one plain space already.
WIDE_WS = r"[\x{1680}-\x{3000}]"
_LATIN_WS = r"[\t-\r\x1C-\x20\x{85}\x{A0}]"
LATIN_WS_TO_MEND = r"[\t-\r\x1C-\x1F\x{85}\x{A0}]" + _LATIN_WS + "*| " + _LATIN_WS + "+"
EDGE_WS = "^" + WS + "+|" + WS + "+$"

# One token: maximal run of word characters and hyphens, trimmed to start and
# end on a word character (what ``\b[\w-]+\b`` yields on each run).
TOKEN = WORD + r"(?:[\p{L}\p{N}_-]*" + WORD + r")?"

BEFORE = "(?<!" + WORD + ")"   # previous char is not a word char (or start)
AFTER = "(?!" + WORD + ")"     # next char is not a word char (or end)
AFTER_WORD = "(?<=" + WORD + ")"  # previous char is a word char
BEFORE_WORD = "(?=" + WORD + ")"  # next char is a word char


def is_word_char(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def word_bounded(literal: str) -> str:
    """Java regex for ``\\b<literal>\\b`` with Unicode word semantics.

    ``\\b`` next to a word character means "neighbour is not a word char";
    next to a non-word character (``.NET``, ``C++``) it means "neighbour is a
    word char".
    """
    left = BEFORE if is_word_char(literal[0]) else AFTER_WORD
    right = AFTER if is_word_char(literal[-1]) else BEFORE_WORD
    return left + r"\Q" + literal + r"\E" + right


def word_bounded_literal_first(literal: str) -> str:
    """Same match set as ``word_bounded`` (case-sensitive), written with the
    literal first and the left boundary as a look-behind over the literal,
    so java.util.regex can search the literal with Boyer-Moore instead of
    testing a look-behind at every position."""
    q = r"\Q" + literal + r"\E"
    n = len(literal)
    left = ("(?<!" if is_word_char(literal[0]) else "(?<=") + WORD + ".{" + str(n) + "})"
    right = AFTER if is_word_char(literal[-1]) else BEFORE_WORD
    return q + left + right


def re2_quote(literal: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}-])", r"\\\1", literal)
