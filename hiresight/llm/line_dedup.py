"""Line dedup over the whole corpus (operator 13), in DataFrame functions only.

A line's key is the line without white space around it, in lower case (A-Z).
Keys found in at least ``min_docs`` documents lose their lines: all of them
(``keep="none"``), or all but the first by document and position
(``keep="first"``). The result is not the text but, for each document that
loses lines, its keep bitmap in run-length form.

1. One pass turns the lines into 128-bit key hashes with (document, position),
   written as a narrow table in the shared folder. No text is moved.
2. The hashes are partitioned by range and sorted by document and position
   within a hash. A window streams over each hash's rows and marks the first
   occurrence in each document; their sum is the document count. The range
   partitioning serves the windows, so the lines are moved once.
3. Only the lines that go are moved again, to their documents, where sorted
   positions are folded into runs.

A hash with over 1 / ``HOT_SHARE`` of all lines would fill one task. A
frequent-items sketch (one pass, at most ``HOT_KEYS`` items) names these, and
they are dealt over ``SALTS`` ranges by document. Their document counts are
exact counts of a pass over the narrow table. The sketch decides where rows go, never
what becomes of them.

Defined results: null and empty texts are one empty line; keys shorter than
``min_chars`` code points never go; a document is a ``doc_id`` (null counts as
one), and rows that repeat a ``doc_id`` count once, each row keeping its own
bitmap by its text; equal rows get equal bitmaps; extra columns are ignored; an
empty table gives an empty result. Two keys share a 128-bit hash with a chance
under 1e-14 for 1e12 different lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import stored

HOT_KEYS, HOT_SHARE, SALTS = 512, 2000, 64
#: items that the sketch tracks: its error is under 1 / HOT_SHARE of the lines
TRACKED = 16_384
_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines(text: Column) -> Column:
    """The text's lines (null or empty: one empty line)."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    ascii_only = F.octet_length(line) == F.char_length(line)  # lower() changes A-Z alone there, and is cheaper
    return F.btrim(F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER)), F.lit(_WHITE))


def _body(text: Column) -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, body, pos, h1, h2) of all lines whose key is long enough."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    keyed = rows.select("doc", _body(F.col("text")).alias("body"), F.posexplode(F.transform(lines(F.col("text")), line_key)).alias("pos", "key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "doc", "body", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(13), "key").alias("h2"))


def _hot(hashes: DataFrame) -> list[int]:
    """First halves of the hashes that hold a large share of all lines."""
    top, n = hashes.agg(F.expr(f"approx_top_k(h1, {HOT_KEYS}, {TRACKED})"), F.count(F.lit(1))).first()
    return [x["item"] for x in top or [] if x["count"] * HOT_SHARE >= n]


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """(doc_id, body, n_dropped, dropped) of every document that loses lines:
    ``dropped`` are the bitmap's zero runs as (at, len), by line number from 0;
    ``body`` is the hash that tells rows with the same doc_id apart."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep is 'none' or 'first', not {keep!r}")
    if min_chars < 1:
        raise ValueError("min_chars is at least 1")
    hashes = stored(_hashes(docs, min_chars))
    hot = _hot(hashes)
    is_hot = F.col("h1").isin(hot) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.xxhash64("doc", "body"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    ranged = hashes.withColumn("salt", salt).repartitionByRange("h1", "h2", "salt")
    group = Window.partitionBy("h1", "h2", "salt")
    stream = group.orderBy("doc", "pos", "body")
    new_doc = (F.row_number().over(stream) == 1) | ~F.lag("doc").over(stream).eqNullSafe(F.col("doc"))
    marked = ranged.withColumn("new", new_doc.cast("long")).withColumn("at", F.row_number().over(stream))
    counted = marked.withColumn("docs", F.sum("new").over(group))
    first = F.col("at") == 1
    if hot:
        totals = hashes.where(is_hot).groupBy("h1", "h2").agg(
            F.count_distinct(F.struct("doc")).alias("all_docs"), F.min(F.struct("doc", "pos", "body")).alias("least"))
        # at most HOT_KEYS first halves
        counted = counted.join(F.broadcast(totals), ["h1", "h2"], "left").withColumn("docs", F.coalesce("all_docs", "docs"))
        first = F.when(F.col("least").isNull(), first).otherwise(F.struct("doc", "pos", "body").eqNullSafe(F.col("least")))
    gone = F.col("docs") >= min_docs
    if keep == "first":
        gone = gone & ~first
    places = counted.where(gone).groupBy("doc", "body").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    starts = F.filter("p", lambda x, i: (i == 0) | (F.get("p", i - 1) < x - 1))
    ends = F.filter("p", lambda x, i: (i == F.size("p") - 1) | (F.get("p", i + 1) > x + 1))
    return places.select("doc", "body", F.size("p").cast("long").alias("n_dropped"), starts.alias("s"), ends.alias("e")).select(
        F.col("doc").alias("doc_id"), "body", "n_dropped",
        F.transform("s", lambda s, i: F.struct(s.alias("at"), (F.get("e", i) - s + 1).alias("len"))).alias("dropped"))


def kept_text(text: Column, dropped: Column) -> Column:
    """The text without the lines of the bitmap's zero runs (null: the text)."""
    all_lines = lines(text)

    def stretch(i: Column) -> Column:
        before, here = F.get(dropped, i - 1), F.get(dropped, i)
        lo = F.when(i == 0, F.lit(0)).otherwise(before["at"] + before["len"])
        hi = F.coalesce(here["at"], F.size(all_lines))
        return F.slice(all_lines, lo + 1, hi - lo)

    pieces = F.flatten(F.transform(F.sequence(F.lit(0), F.size(dropped)), stretch))
    return F.when(dropped.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(pieces, "\n"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row of ``docs``, without the
    lines that its bitmap drops."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).withColumn("of", _body(F.col("text")))
    joined = rows.join(bitmaps, rows["doc"].eqNullSafe(bitmaps["doc_id"]) & (rows["of"] == bitmaps["body"]), "left")
    return joined.select(F.col("doc").alias("doc_id"), kept_text(F.col("text"), F.col("dropped")).alias("text"),
                         F.size(lines(F.col("text"))).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"))
