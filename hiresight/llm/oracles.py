"""DuckDB SQL of the queries that SQL can express: all pairs, all windows and
all n-grams, without the operators' data structures."""

from __future__ import annotations

from .repetition import Limits

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def repetition(limits: Limits = Limits()) -> str:
    chars = "greatest(word_chars, 1)"
    tops = [f"coalesce(max(CASE WHEN n = {n} AND k > 2 THEN k * ch END), 0)" for n in (2, 3, 4)]
    cover = ", ".join(f"coalesce(max(CASE WHEN n = {n} THEN chars END), 0)::BIGINT AS dup{n}_chars" for n in range(5, 11))
    rules = [f"top{n}_chars <= {v} * {chars}" for n, v in limits.top_ngram.items()]
    rules += [f"dup{n}_chars <= {v} * {chars}" for n, v in limits.duplicate_ngram.items()]
    rules += [f"n_words >= {limits.min_words}", f"n_symbols <= {limits.symbols_per_word} * n_words",
              f"n_dup_lines <= {limits.duplicate_lines} * n_lines + 1", f"dup_line_chars <= {limits.duplicate_line_chars} * {chars}"]
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
tok AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, {_SPACED}) AS w FROM t)),
c AS (SELECT doc_id, count(*) AS n_words, sum(length(x)) AS word_chars FROM tok GROUP BY doc_id),
ld AS (SELECT doc_id, i, x, {', '.join(f'lead(x, {k}) OVER q AS x{k}' for k in range(1, 10))} FROM tok WINDOW q AS (PARTITION BY doc_id ORDER BY i)),
g AS ({' UNION ALL '.join(f"SELECT doc_id, {n} AS n, i, concat_ws(' ', x, {', '.join(f'x{k}' for k in range(1, n))}) AS g FROM ld WHERE x{n - 1} IS NOT NULL" for n in range(2, 11))}),
s AS (SELECT doc_id, n, g, length(g) - n + 1 AS ch, count(*) AS k, list(i) AS places FROM g GROUP BY doc_id, n, g HAVING count(*) > 1),
top AS (SELECT doc_id, {', '.join(f'{x} AS top{n}' for n, x in zip((2, 3, 4), tops))} FROM s GROUP BY doc_id),
p AS (SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS p FROM (SELECT doc_id, n, unnest(places) AS i FROM s WHERE n = 3 OR n >= 5)),
pc AS (SELECT p.doc_id, n, count(*) AS words, sum(length(x)) AS chars FROM p JOIN tok ON tok.doc_id = p.doc_id AND tok.i = p.p GROUP BY p.doc_id, n),
cov AS (SELECT doc_id, coalesce(max(CASE WHEN n = 3 THEN words END), 0)::BIGINT AS n_repeat_words, {cover} FROM pc GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
lc AS (SELECT doc_id, line, count(*) AS k FROM ln WHERE regexp_matches(line, {_SPACED}) GROUP BY doc_id, line),
l AS (SELECT doc_id, sum(k)::BIGINT AS n_lines, sum(k - 1)::BIGINT AS n_dup_lines, sum((k - 1) * length(line))::BIGINT AS dup_line_chars FROM lc GROUP BY doc_id),
m AS (SELECT t.doc_id, coalesce(c.n_words, 0)::BIGINT AS n_words, coalesce(c.word_chars, 0)::BIGINT AS word_chars,
        length(regexp_replace(t.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(dup_line_chars, 0) AS dup_line_chars,
        coalesce(n_repeat_words, 0) AS n_repeat_words, {', '.join(f'coalesce(dup{n}_chars, 0) AS dup{n}_chars' for n in range(5, 11))},
        {', '.join(f'least(coalesce(top{n}, 0), coalesce(c.word_chars, 0))::BIGINT AS top{n}_chars' for n in (2, 3, 4))}
      FROM t LEFT JOIN c ON c.doc_id = t.doc_id LEFT JOIN l ON l.doc_id = t.doc_id LEFT JOIN cov ON cov.doc_id = t.doc_id LEFT JOIN top ON top.doc_id = t.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {' AND '.join(rules)} AS kept FROM b"""


def contamination() -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents),
it AS (SELECT item_id, regexp_extract_all({_LOWER.format('text')}, {_ALNUM}) AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i+n-1], ' ') AS g FROM (
  SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM it WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS g FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN win USING (n, g)),
f AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM hit GROUP BY doc_id),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN f USING (doc_id) LEFT JOIN c USING (doc_id)"""


def jaccard() -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_SPACED}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 180 * k >= 80 * (x.n + y.n)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS k FROM link GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(least_of.b, d.doc_id)) AS class_id, coalesce(many.k, 0) AS n_links, coalesce(n.n, 0) AS n_shingles
FROM d LEFT JOIN least_of ON least_of.a = d.doc_id LEFT JOIN many ON many.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""


def divergence() -> str:
    def share(count: str, total: str) -> str:
        return f"1 + (1000000000::HUGEINT * ({count} + 2)) // ({total} + 2 * v)"

    def f(p: str, q: str) -> str:
        return f"({p} - {q}) * ({p} - {q}) // ({p} + {q})"

    words = rf"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {words} AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
cnt AS (SELECT lang, source, term, count(*) AS c FROM o SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
vs AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN cnt USING (lang, source) GROUP BY g.lang, g.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, {share("coalesce(c, 0)", "n.n")} AS p
  FROM g JOIN kept k ON k.lang = g.lang JOIN vs ON vs.lang = g.lang JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.term = k.term),
ln AS (SELECT lang, sum(n) AS n FROM n GROUP BY lang),
q AS (SELECT lang, term, {share("sum(c)", "any_value(ln.n)")} AS q FROM cnt JOIN ln USING (lang) JOIN vs USING (lang) GROUP BY lang, term, v),
pair AS (SELECT a.lang, a.source, b.source AS item, sum({f("a.p", "b.p")}) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
part AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN pair ON pair.lang = x.lang AND pair.source = x.source AND pair.item = y.source
  UNION ALL SELECT p.lang, p.source, 'term', p.term, ({f("p.p", "q.q")})::BIGINT FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE c > 0 AND p.p > q.q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM part)
WHERE part = 'pair' OR rank <= 10"""


def line_dedup() -> str:
    white = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
l AS (SELECT r, doc_id, unnest(w) AS line, generate_subscripts(w, 1) AS i FROM t),
k AS (SELECT *, {_LOWER.format(f"trim(line, {white})")} AS key FROM l),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'none')) >= 10),
m AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often ON often.key = k.key)
SELECT first(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r"""


LLM_ORACLES = {"op3_repetition": repetition(), "op7_decontaminate": contamination(), "op10_jaccard_join": jaccard(),
               "op11_divergence": divergence(), "op13_line_dedup": line_dedup()}
