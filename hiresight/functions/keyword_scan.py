"""All keywords of a dictionary that a text contains, without searching the
text once per keyword.

An exact prefilter runs over the text once. A few letters are chosen that are
rare in texts and cover the dictionary: every keyword has one of them. Each
keyword is represented by its tail from such a letter on. The tails form a
trie, written as one regular expression that is only tried where one of the
chosen letters stands, and gives the longest tail that begins there (shorter
tails at the same place are prefixes of it, which a table of the dictionary
knows). A keyword whose tail does not occur cannot occur; the few others are
confirmed one by one. Letter frequencies decide the speed, never the result.

Keywords are substrings (``find_keywords``) or whole words (``find_words``):
next to a word character of the keyword stands no word character, next to
another character of it (``C++``, ``.NET``) stands one, as ``\\b`` has it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import AFTER, BEFORE_WORD, is_word_char, word_bounded_literal_first

#: percentages of letters in English texts; blanks are frequent, others rare
FREQUENCY = dict(zip("etaoinshrdlcumwfgypbvkjxqz", (
    12.7, 9.1, 8.2, 7.5, 7.0, 6.7, 6.3, 6.1, 6.0, 4.3, 4.0, 2.8, 2.8, 2.4, 2.4, 2.2, 2.0, 2.0, 1.9, 1.5, 1.0, 0.8, 0.2, 0.2, 0.1, 0.1),
    strict=True)) | {" ": 18.0}
_END = ""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _frequency(ch: str) -> float:
    return FREQUENCY.get(ch.lower(), 0.5)


def tails(words: Iterable[str]) -> dict[str, str]:
    """The tail of each word. A tail of one character would say little, so a
    word's last character is no start unless it is the only one."""
    heads = {w: set(w[:-1] or w) for w in words}
    chosen: set[str] = set()
    left = set(heads)
    while left:  # the letter that covers most words for its frequency
        letters = {c for w in left for c in heads[w]}
        best = max(sorted(letters), key=lambda c: sum(c in heads[w] for w in left) / _frequency(c))
        chosen.add(best)
        left = {w for w in left if best not in heads[w]}
    return {w: w[w.index(min(sorted(h & chosen), key=_frequency)):] for w, h in heads.items()}


def _trie(words: Iterable[str]) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[_END] = is_word_char(w[-1])
    return root


def _quoted(ch: str) -> str:
    return ch if ch.isalnum() or ch in " _" else "\\" + ch if ch.isascii() else f"\\x{{{ord(ch):X}}}"


def _pattern(node: dict, bounded: bool) -> str:
    """What follows a node: the longest way on first, then the node's own end
    (``bounded``: as ``\\b`` has it)."""
    ways = []
    for ch in sorted(k for k in node if k != _END):
        text, below = _quoted(ch), node[ch]
        while len(below) == 1 and _END not in below:
            (ch, below), = below.items()
            text += _quoted(ch)
        ways.append(text + _pattern(below, bounded))
    if _END in node and (ways or bounded):
        ways.append("" if not bounded else AFTER if node[_END] else BEFORE_WORD)
    return "" if not ways else ways[0] if len(ways) == 1 else "(?:" + "|".join(ways) + ")"


def scan_pattern(tails: Iterable[str], bounded: bool = False) -> str:
    """Java regex whose group 1 is the longest tail at each place that has one."""
    tails = list(tails)
    starts = "".join(_quoted(c) for c in sorted({t[0] for t in tails}))
    return f"(?=[{starts}])(?=({_pattern(_trie(tails), bounded)}))"


def stands_for(words: Iterable[str], bounded: bool = False) -> dict[str, list[str]]:
    """For each tail, the keywords that may be there where it is the longest
    found: those of all tails that begin it (and could end where they do)."""
    by_tail: dict[str, list[str]] = {}
    for w, t in tails(words).items():
        by_tail.setdefault(t, []).append(w)

    def ends(t: str, k: int) -> bool:
        return k == len(t) or not bounded or is_word_char(t[k - 1]) != is_word_char(t[k])

    return {t: [w for k in range(1, len(t) + 1) if ends(t, k) for w in by_tail.get(t[:k], [])] for t in by_tail}


def possible_keywords(text: Column, words: Iterable[str], bounded: bool = False) -> Column:
    """The keywords whose tails occur in ``text``, without repeats (null text:
    null). All keywords that occur are among them."""
    meant = stands_for(dict.fromkeys(words), bounded)
    table = F.create_map(*[x for t, ws in meant.items() for x in (F.lit(t), F.array(*[F.lit(w) for w in ws]))])
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(scan_pattern(meant, bounded)), F.lit(1)))
    return F.array_distinct(F.flatten(F.transform(found, lambda t: table[t])))


def _none_of(text: Column) -> Column:
    return F.when(text.isNotNull(), F.array().cast("array<string>"))


def find_keywords(text: Column, words: Iterable[str]) -> Column:
    """The distinct keywords that are substrings of ``text`` (null text: null)."""
    words = list(dict.fromkeys(words))
    some = [w for w in words if w]
    found = let(text, lambda t: F.filter(possible_keywords(t, some), lambda k: t.contains(k))) if some else _none_of(text)
    if len(some) < len(words):  # every text contains the empty keyword
        found = F.array_union(found, F.array(F.lit("")))
    return found


def find_words(text: Column, words: Iterable[str]) -> Column:
    """The distinct keywords that are whole words of ``text`` (null text: null)."""
    some = [w for w in dict.fromkeys(words) if w]
    if not some:
        return _none_of(text)
    rx = F.create_map(*[F.lit(x) for w in some for x in (w, word_bounded_literal_first(w))])
    return let(text, lambda t: F.filter(possible_keywords(t, some, bounded=True), lambda k: F.rlike(t, rx[k])))


def count_found(found: Column, words: Iterable[str]) -> Column:
    """How many of ``words`` (repeats count again) are in ``found``; null: 0."""
    listed = F.array(*[F.lit(w) for w in words]).cast("array<string>")
    return F.coalesce(F.size(F.filter(listed, lambda k: F.array_contains(found, k))), F.lit(0))
