"""HTML extraction by wrapper inference (operator 2).

1. Each page becomes a token stream, read as nested elements. Inside a page,
   neighbouring elements of one label are aligned with each other and become a
   repeated group, also groups of up to ``PERIOD`` different labels.
2. The forms of a host's pages are aligned one after the other. Elements that
   only one side has become optional, text becomes a slot. The result is the
   host's wrapper, a regular expression without unions.
   Equal forms are summed up by Spark first, then merged in groups of at most
   ``FORMS`` forms, round by round until each host has one wrapper, so a host
   with a third of all pages needs no large task.
3. The wrapper tells where a host keeps its main text: below its article
   elements, else its main element, else the deepest element that holds most
   of the text outside boilerplate. A page without that place is read by its
   own form.
4. Extraction reads the text slots of that place, without menus, headers,
   footers, sidebars, notices, adverts, forms, scripts, styles and comments.

Defined results: null and empty html give the empty text; pages without a URL
share the empty host; text in unclosed or misnested elements is kept; in
wrappers, elements nested deeper than ``DEPTH`` are read as content of that level,
but for article and main elements, and boilerplate, which is left out; repeated
rows give equal rows; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import checkpointed

DEPTH, PERIOD, FORMS = 60, 4, 200

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*+>|<\?[^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|</?[a-zA-Z][^>]*+\Z|([^<]++)|(<)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"\s+")
_NO_WORD = re.compile(r"[^a-z_-]+")
_PART = re.compile(r"[-_]+")

# Fixed values of HTML: elements without content, raw text, block elements, and
# start tags that end an open element.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "li", "dd", "dt", "legend", "option", "optgroup", "summary", "figcaption"}
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CONTAINERS = frozenset("blockquote body center div html section table tbody td".split())
_SCOPE = frozenset("ul ol dl table select article section div body html".split())

# Elements and class words that are not main text.
_BOILER = frozenset("aside button dialog footer form head iframe input menu nav noscript script select style svg template textarea title".split())
_BOILER_WORDS = frozenset("ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus dropdown footer gdpr hidden legal login menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion recommended related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget commentlist".split())
_HEADER_WORDS = frozenset("header masthead topbar".split())
# Of these, words that also name a topic: on a text element inside an article they say nothing.
_TOPICS = frozenset("alert banner copyright legal login menu notice notification promo promotion recommended related replies reply search share sharing skip social subscription widget".split())
_TEXT = frozenset("a b blockquote code dd dl dt em figcaption figure h1 h2 h3 h4 h5 h6 i li ol p pre section span strong table td th tr ul".split())
# Parts of compound classes: with a boilerplate word they only say what kind of box it is (share-buttons) ...
_BOXES = frozenset("area bar block blog body bottom box button buttons card cards container content feed fixed form global group header heading icon icons inner item items left link links list main message mobile module outer overlay page panel post posts primary right row secondary section site slot sticky stories strip tab tabs thread title top unit wrap wrapper zone".split())
# ... and with one of these, that the page has such a box somewhere, or not (no-sidebar).
_STATES = frozenset("closed disabled enabled has have hide is no non not off on open with without".split())
# Elements that no class word makes boilerplate.
_NEVER = frozenset("body html".split())


def _label(tag: str, attributes: str) -> str:
    """The tag and the whole words of its class, id and role, without digits."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return tag
    words: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            words.update(w for w in (_NO_WORD.sub("", x).strip("-_") for x in value.lower().split()) if w)
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            words.add("hidden")
    return ".".join([tag, *sorted(words)]) if words else tag


@lru_cache(1 << 14)
def _votes(word: str) -> tuple[bool, bool]:
    """If a class word calls its element boilerplate, and if by a topic alone. All
    parts of a compound must agree: one of them is no evidence."""
    if word in _BOILER_WORDS:
        return True, word in _TOPICS
    parts = _PART.split(word)
    named = [x for x in parts if x in _BOILER_WORDS]
    if not named or len(parts) == 1 or not _STATES.isdisjoint(parts) or not all(x in _BOILER_WORDS or x in _BOXES for x in parts):
        return False, False
    return True, all(x in _TOPICS for x in named) and len(parts) == len(named)


@lru_cache(1 << 16)
def _boiler(label: str, in_article: bool) -> bool:
    tag, *words = label.split(".")
    if tag in _BOILER:
        return True
    if tag not in _NEVER:
        for yes, topic in map(_votes, words):
            if yes and not (topic and in_article and tag in _TEXT):
                return True
    return not in_article and tag not in ("body", "html") and (tag == "header" or not _HEADER_WORDS.isdisjoint(words))


def _place(label: str) -> str | None:
    tag, *words = label.split(".")
    if tag == "article" or "articlebody" in words:
        return "article"
    return "main" if tag == "main" or "main" in words else None


def events(html: str) -> Iterator[tuple[int, str]]:
    """(1, label) opens an element, (-1, "") closes the last open one, (0, text)
    is text, (2, tag) an element without content; nesting is always proper."""
    stack: list[str] = []
    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.match(html, at)
        at = m.end()
        if m[7] is not None or m[8] is not None:
            yield 0, m[7] or m[8]
            continue
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if tag in stack:
                while True:
                    top = stack.pop()
                    yield -1, ""
                    if top == tag:
                        break
            continue
        ended = _ENDS.get(tag)
        if ended:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] in ended:
                    while len(stack) > k:
                        stack.pop()
                        yield -1, ""
                    break
                if stack[k] in _SCOPE:
                    break
        elif tag in _CLOSES_P and "p" in stack:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] == "p":
                    while len(stack) > k:
                        stack.pop()
                        yield -1, ""
                    break
                if stack[k] in _SCOPE:
                    break
        attributes = m[3] if m[2] else m[6]
        if tag in _VOID:
            yield 2, tag
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}\b", re.I).search(html, at)
            raw_end = close.start() if close else end
            yield 1, tag
            if raw_end > at:
                yield 0, html[at:raw_end]
            yield -1, ""
            at = raw_end if not close else html.find(">", raw_end) + 1 or end
            continue
        stack.append(tag)
        yield 1, _label(tag, attributes)
    for _ in stack:
        yield -1, ""


def _below(path: str, depth: int, label: str, deep: frozenset[str]) -> tuple[str, frozenset[str]]:
    """Path of an element that opens below ``depth`` others. Paths end at ``DEPTH``
    elements, but for the first article and main element further below (``deep``)."""
    if depth < DEPTH:
        return f"{path}/{label}", deep
    kind = _place(label)
    return (f"{path}/{label}", deep | {kind}) if kind and kind not in deep else (path, deep)


def outline(html: str) -> Iterator[tuple[int, str]]:
    """``events`` with at most ``DEPTH`` + 2 open elements, as paths have them:
    deeper elements give their content to their parent, deep boilerplate is left out."""
    stack: list[tuple[bool, bool, bool, frozenset[str]]] = [(True, False, False, frozenset())]  # shown, dropped, inside an article, deep
    for kind, value in events(html):
        _, drop, article, deep = stack[-1]
        if kind == 1:
            depth = len(stack) - 1
            path, now = _below("", depth, value, deep)
            drop = drop or depth >= DEPTH and _boiler(value, article)
            stack.append((path != "" and not drop, drop, article or _place(value) == "article", now))
            if stack[-1][0]:
                yield kind, value
        elif kind == -1:
            if stack.pop()[0]:
                yield kind, value
        elif not drop:
            yield kind, value


# -- wrappers ------------------------------------------------------------
# A wrapper node is (label, optional, repeated, children); "#" is a text slot,
# "()" a group of several elements. Nodes are interned, merges are remembered.

class Grammar:
    def __init__(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.nodes: list[tuple[str, bool, bool, tuple[int, ...]]] = []
        self.merged: dict[tuple[int, int], int] = {}
        self.aligned: dict[tuple[tuple[int, ...], tuple[int, ...]], tuple[int, ...]] = {}
        self.folded: dict[tuple[int, ...], tuple[int, ...]] = {}

    def node(self, label: str, optional: bool = False, repeated: bool = False, children: tuple[int, ...] = ()) -> int:
        key = (label, optional, repeated, children)
        got = self.ids.get(key)
        if got is None:
            got = self.ids[key] = len(self.nodes)
            self.nodes.append(key)
        return got

    def flagged(self, i: int, optional: bool = False, repeated: bool = False) -> int:
        label, o, r, c = self.nodes[i]
        return self.node(label, o or optional, r or repeated, c)

    def shape(self, i: int) -> str:
        label, _, _, c = self.nodes[i]
        return label if label != "()" else "(" + " ".join(self.shape(x) for x in c) + ")"

    def merge(self, a: int, b: int) -> int:
        """The least node that generates what two nodes of one label do."""
        if a == b:
            return a
        key = (min(a, b), max(a, b))
        got = self.merged.get(key)
        if got is None:
            x, y = self.nodes[a], self.nodes[b]
            got = self.merged[key] = self.node(x[0], x[1] or y[1], x[2] or y[2], self.align(x[3], y[3]))
        return got

    def align(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
        """Longest common subsequence by label; the rest becomes optional."""
        if a == b:
            return a
        got = self.aligned.get((a, b))
        if got is not None:
            return got
        la, lb = [self.shape(x) for x in a], [self.shape(x) for x in b]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            row, below = best[i], best[i + 1]
            for j in range(len(b) - 1, -1, -1):
                row[j] = below[j + 1] + 1 if la[i] == lb[j] else max(below[j], row[j + 1])
        out, i, j = [], 0, 0
        while i < len(a) or j < len(b):
            if i < len(a) and j < len(b) and la[i] == lb[j]:
                out.append(self.merge(a[i], b[j]))
                i, j = i + 1, j + 1
            elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
                out.append(self.flagged(a[i], optional=True))
                i += 1
            else:
                out.append(self.flagged(b[j], optional=True))
                j += 1
        self.aligned[a, b] = got = self.fold(tuple(out))
        return got

    def fold(self, seq: tuple[int, ...]) -> tuple[int, ...]:
        """Neighbouring repeats of one to ``PERIOD`` labels become a repeated node."""
        got = self.folded.get(seq)
        if got is not None:
            return got
        now = list(seq)
        for period in range(1, PERIOD + 1):
            out: list[int] = []
            shapes: list[str] = []
            for x in now:
                out.append(x)
                shapes.append(self.shape(x))
                if period == 1:
                    if len(out) > 1 and shapes[-1] == shapes[-2]:
                        last = self.merge(out[-2], out.pop())
                        shapes.pop()
                        out[-1] = self.flagged(last, repeated=True)
                    continue
                group = "(" + " ".join(shapes[-period:]) + ")"
                if len(out) > period and shapes[-period - 1] == group:
                    tail = self.node("()", children=tuple(out[-period:]))
                    del out[-period:], shapes[-period:]
                    out[-1] = self.flagged(self.merge(out[-1], tail), repeated=True)
                elif len(out) >= 2 * period and shapes[-period:] == shapes[-2 * period : -period]:
                    one = self.node("()", children=tuple(out[-2 * period : -period]))
                    two = self.node("()", children=tuple(out[-period:]))
                    del out[-2 * period :], shapes[-2 * period :]
                    out.append(self.flagged(self.merge(one, two), repeated=True))
                    shapes.append(group)
            now = out
        self.folded[seq] = got = tuple(now)
        return got

    def page(self, html: str) -> int:
        """The form of one page."""
        slot = self.node("#")
        stack: list[tuple[str, list[int]]] = [("", [])]
        for kind, value in outline(html):
            if kind == 1:
                stack.append((value, []))
            elif kind == -1:
                label, children = stack.pop()
                self._add(stack[-1][1], self.node(label, children=self.fold(tuple(children))))
            elif kind == 0:
                if not value.isspace():
                    self._add(stack[-1][1], slot)
            elif value != "br":
                self._add(stack[-1][1], self.node(value))
        return self.node("", children=self.fold(tuple(stack[0][1])))

    def _add(self, children: list[int], x: int) -> None:
        """Append, folding equal labels at once: long lists stay short."""
        if children and self.nodes[children[-1]][0] == self.nodes[x][0] != "()":
            children[-1] = self.flagged(self.merge(children[-1], x), repeated=True) if self.nodes[x][0] != "#" else x
        else:
            children.append(x)

    def dump(self, i: int) -> list:
        label, o, r, c = self.nodes[i]
        return [label, int(o), int(r), [self.dump(x) for x in c]]

    def load(self, tree: list) -> int:
        return self.node(tree[0], bool(tree[1]), bool(tree[2]), tuple(self.load(x) for x in tree[3]))


def regex(tree: list) -> str:
    """A wrapper as text."""
    label, optional, repeated, children = tree
    inner = "".join(regex(c) for c in children)
    out = "#TEXT" if label == "#" else f"({inner})" if label in ("", "()") else f"<{label}>{inner}</{label.split('.')[0]}>"
    sign = {(0, 0): "", (1, 0): "?", (0, 1): "+", (1, 1): "*"}[bool(optional), bool(repeated)]
    return f"({out}){sign}" if sign and label != "()" else out + sign


def places(tree: list, mass: dict[str, int] | None = None) -> frozenset[str]:
    """Paths of the elements that hold the main text: article elements, else main
    elements, else the deepest container of most text by ``mass``. Elements that
    class words call boilerplate count only where there is nothing else: then the
    words do not hide article and main elements, nor text."""
    found: dict[str, set[str]] = {"article": set(), "main": set()}
    holders: dict[str, int] = {}

    def walk(node: list, path: str, article: bool, words: bool = True) -> None:
        label = node[0]
        if label == "#":
            for k in range(path.count("/") + 1) if mass and path in mass else ():
                up = "/".join(path.split("/")[: k + 1])
                holders[up] = holders.get(up, 0) + mass[path]
            return
        if label not in ("", "()"):
            if _boiler(label, article) if words else label.partition(".")[0] in _BOILER:
                return
            path = f"{path}/{label}"
            kind = _place(label)
            if kind:
                found[kind].add(path)
                article = article or kind == "article"
        for c in node[3]:
            walk(c, path, article, words)

    walk(tree, "", False)
    if not found["article"] and not found["main"]:
        clear = dict(holders)
        holders.clear()
        walk(tree, "", False, False)
        holders = clear or holders
    if found["article"] or found["main"]:
        return frozenset(found["article"] or found["main"])
    if not holders:
        return frozenset()
    total = max(holders.values())
    wide = [p for p, v in holders.items() if 2 * v > total and (not p or p.rpartition("/")[2].partition(".")[0] in _CONTAINERS)]
    return frozenset({max(wide, key=lambda p: (p.count("/"), p))})


def masses(html: str) -> dict[str, int]:
    """Characters of text directly in each element, by path."""
    out: dict[str, int] = {}
    path = [""]
    for kind, value in outline(html):
        if kind == 1:
            path.append(f"{path[-1]}/{value}")
        elif kind == -1:
            path.pop()
        elif kind == 0:
            out[path[-1]] = out.get(path[-1], 0) + len(value.strip())
    return out


def main_text(html: str, where: frozenset[str]) -> str:
    """The blocks of text below the given paths, boilerplate left out. Of several
    places (teaser articles beside the story) the one whose element holds most
    text counts, with all elements of its path."""
    found: list[tuple[str, list[str]]] = [("", [])]
    words: list[str] = []
    # class words do not drop the places and their ancestors
    opened = {"/".join(p.split("/")[: k + 1]) for p in where for k in range(p.count("/") + 1)}
    # of each open element: path, inside the place, dropped, inside an article, block, deep places
    stack = [("", "" in where, False, False, False, frozenset())]

    def flush() -> None:
        if words:
            block = _SPACE.sub(" ", unescape("".join(words))).strip()
            if block:
                found[-1][1].append(block)
            words.clear()

    for kind, value in events(html):
        path, inside, drop, article, _, deep = stack[-1]
        if kind == 0:
            if inside and not drop:
                words.append(value)
        elif kind == 1:
            tag = value.partition(".")[0]
            block = tag in _BLOCK
            if block:
                flush()
            above = path
            path, deep = _below(path, len(stack) - 1, value, deep)
            drop = drop or _boiler(value, article) and (path == above or path not in opened or tag in _BOILER)
            if not inside and path in where:
                flush()
                found.append((path, []))
            stack.append((path, inside or path in where, drop, article or _place(value) == "article", block, deep))
        elif kind == -1:
            if stack.pop()[4]:
                flush()
        elif value == "br":
            words.append(" ")
        elif value == "hr":
            flush()
    flush()
    most = max(found, key=lambda x: sum(map(len, x[1])))[0]
    return "\n".join(b for path, blocks in found if path == most for b in blocks)


# -- Spark ---------------------------------------------------------------

def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/:?#]+)", 1))
    return pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))


def _merge_forms(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    g = Grammar()
    rows = frame.sort_values(["pages", "form"], ascending=[False, True])
    out = None
    mass: dict[str, int] = {}
    for form, m in zip(rows["form"], rows["mass"], strict=True):
        one = g.load(json.loads(form))
        out = one if out is None else g.merge(out, one)
        for k, v in json.loads(m).items():
            mass[k] = mass.get(k, 0) + v
    return pd.DataFrame({"host": [key[0]], "form": [json.dumps(g.dump(out))], "pages": [int(rows["pages"].sum())], "mass": [json.dumps(mass)]})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, form, pages, mass): each host's wrapper as JSON. ``mass`` has the
    characters by element, of pages that have no article or main element."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, text, seen = Grammar(), {}, {}

        def batch() -> pa.RecordBatch:
            host, form, n, mass = zip(*((h, f, n, json.dumps(m)) for (h, f), (n, m) in seen.items()), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(form, pa.string()), pa.array(n, pa.int64()), pa.array(mass, pa.string())], names=["host", "form", "pages", "mass"])

        for b in batches:
            for html, host in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                i = g.page(html)
                if i not in text:
                    tree = g.dump(i)
                    text[i] = (json.dumps(tree), bool(places(tree)))
                form, clear = text[i]
                n, mass = seen.setdefault((host, form), (0, {}))
                if not clear:
                    for k, v in masses(html).items():
                        mass[k] = mass.get(k, 0) + v
                seen[host, form] = (n + 1, mass)
            if len(seen) > 2_000 or len(g.nodes) > 200_000:
                yield batch()
                g, text, seen = Grammar(), {}, {}
        if seen:
            yield batch()

    schema = "host string, form string, pages long, mass string"
    found = with_host(pages).select("html", "host").mapInArrow(run, schema)
    forms = checkpointed(found.groupBy("host", "form", "mass").agg(F.sum("pages").alias("pages")))
    while True:
        size = forms.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        most = size.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return forms
        parts = F.ceil(F.col("n") / FORMS)
        forms = checkpointed(forms.join(size, "host").withColumn("part", F.pmod(F.xxhash64("form", "mass"), parts))
                             .groupBy("host", "part").applyInPandas(_merge_forms, schema))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages`` (page_id, url, html)."""
    wrappers = infer_wrappers(pages).select("host", "form", "mass")
    rows = with_host(pages).join(wrappers, "host", "left").select("page_id", "url", "html", "form", "mass")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], frozenset[str]] = {}
        g = Grammar()
        for b in batches:
            out = []
            for html, form, mass in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                where = known.get((form, mass))
                if where is None:
                    if len(known) > 1_000:
                        known.clear()
                    where = known[form, mass] = places(json.loads(form), json.loads(mass))
                text = main_text(html, where)
                if not text and html:
                    if len(g.nodes) > 200_000:
                        g = Grammar()
                    text = main_text(html, places(g.dump(g.page(html)), masses(html)))
                out.append(text)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
