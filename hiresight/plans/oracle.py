"""Independent SQL (DuckDB) formulations of the registered queries.

These are the correctness oracles: the same semantics written as plain SQL
over the same parquet tables, using RE2 regexes. RE2 has no look-around, so
word boundaries are written as ``(^|[^word])`` / ``([^word]|$)`` groups; for
"first match" extractions this is equivalent. Dictionaries come from the
same fixed-value module, so both sides score against identical lists.
"""

from __future__ import annotations

from ..dictionaries import (
    INDUSTRIES, REMOTE_KEYWORDS, ROLE_FAMILIES, SKILLS, US_PHRASES, US_STATES, flatten,
)
from ..functions.patterns import EDGE_WS, TOKEN, WS, is_word_char, re2_quote
from ..sources.testdata import boards_select_sql, postings_select_sql
from ..operators.trends import family_column

W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"
CODES = [c for c, _ in US_STATES]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def clean(x: str, lower: bool = False) -> str:
    e = f"trim(regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), {q(WS + '+')}, ' ', 'g'))"
    if lower:
        e = f"lower({e})"
    return f"coalesce({e}, '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(EDGE_WS)}, '', 'g')"


def any_contains(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def state_by_code(t: str) -> str:
    rx = "(?:^|" + NW + ")(" + "|".join(CODES) + r")(?:" + WS + r"+\p{Nd}{5})?(?:" + WS + "*,|" + WS + "*$)"
    return f"nullif(regexp_extract(upper({t}), {q(rx)}, 1), '')"


def state_by_name(t: str) -> str:
    whens = " ".join(f"WHEN contains(lower({t}), {q(n.lower())}) THEN {q(c)}" for c, n in US_STATES)
    return f"CASE {whens} END"


def state_code(t: str) -> str:
    return f"coalesce({state_by_code(t)}, {state_by_name(t)})"


def city(t: str, st: str) -> str:
    branches = " ".join(
        f"WHEN {q(c)} THEN regexp_extract({t}, {q('(?i)^(.+?),' + WS + '*' + c + '(?:' + NW + '|$)')}, 1)"
        for c in CODES
    )
    by_state = f"nullif(CASE {st} {branches} END, '')"
    cleaned = f"regexp_replace({strip(by_state)}, {q('(?i)^(?:Greater|Metro)' + WS + '+')}, '')"
    head = strip(f"split_part({t}, ',', 1)")
    codes = ", ".join(q(c) for c in CODES)
    fallback = f"CASE WHEN {head} <> '' AND upper({head}) NOT IN ({codes}) THEN {head} END"
    return f"coalesce({cleaned}, {fallback})"


def postal(t: str) -> str:
    rx = "(?:^|" + NW + r")(\p{Nd}{5})(?:" + NW + "|$)"
    return f"nullif(regexp_extract({t}, {q(rx)}, 1), '')"


def remote(t: str) -> str:
    return f"coalesce({any_contains(f'lower({t})', REMOTE_KEYWORDS)}, false)"


def company_id(name: str, domain: str | None = None) -> str:
    key = strip(f"lower({name})")
    if domain is not None:
        key = f"{key} || '|' || {strip(f'lower({domain})')}"
    return f"substr(sha256({key}), 1, 16)"


def job_key(src: str, company: str, jid: str, title: str) -> str:
    ch = f"substr(sha256({strip(f'lower({company})')}), 1, 8)"
    jh = f"substr(sha256({strip(jid)} || '|' || {strip(f'lower({title})')}), 1, 8)"
    return f"{src} || '_' || {ch} || '_' || {jh}"


def hits(x: str, words) -> str:
    arr = "[" + ", ".join(q(w.lower()) for w in words) + "]"
    return f"len(list_filter({arr}, lambda k: contains({x}, k)))"


def first_best(names, scores) -> tuple[str, str]:
    best = f"greatest({', '.join(scores)})"
    whens = " ".join(f"WHEN {s} = {best} THEN {q(n)}" for n, s in zip(names, scores))
    return f"CASE WHEN {best} > 0 THEN CASE {whens} END END", best


def skill_rx(s: str) -> str:
    left = "(?:^|" + NW + ")" if is_word_char(s[0]) else W
    right = "(?:" + NW + "|$)" if is_word_char(s[-1]) else W
    return "(?i)" + left + re2_quote(s) + right


def skills_list(x: str) -> str:
    items = ", ".join(f"CASE WHEN regexp_matches({x}, {q(skill_rx(s))}) THEN {q(s)} END"
                      for s in dict.fromkeys(flatten(SKILLS)))
    return f"list_sort(list_filter([{items}], lambda z: z IS NOT NULL))"


# ----------------------------------------------------------------- CTE chains

P = f"p AS ({postings_select_sql('documents')})"
B = f"b AS ({boards_select_sql('pages')})"


def canon_ctes(strict: bool = True, known: bool = True) -> str:
    only_known = "WHERE source IN ('greenhouse', 'lever')" if known else ""
    lenient = "false" if strict else "true"
    conf_else = "0.0" if strict else "0.3"
    gh_url = ("CASE WHEN has_url THEN 'https://boards.greenhouse.io/' || company_slug || '/jobs/' || source_job_id "
              "ELSE 'https://boards.greenhouse.io/jobs/' || source_job_id END")
    lv_url = ("CASE WHEN has_url THEN 'https://jobs.lever.co/' || company_slug || '/' || source_job_id "
              "ELSE 'https://jobs.lever.co/' || source_job_id END")
    return f"""{P},
l0 AS (SELECT * REPLACE (coalesce(title, '') AS title, coalesce(location_raw, '') AS location_raw) FROM p {only_known}),
l1 AS (SELECT *, {strip('location_raw')} AS lt, (location_raw IS NULL OR location_raw = '') AS lempty FROM l0),
l2 AS (SELECT *, CASE WHEN lempty THEN NULL ELSE {state_code('lt')} END AS st,
              {any_contains('lower(lt)', US_PHRASES)} AS phrase FROM l1),
canon AS (
  SELECT pos, source, source_job_id,
    CASE source WHEN 'greenhouse' THEN {gh_url} WHEN 'lever' THEN {lv_url} ELSE 'https://jobs.workday.example/' || source_job_id END AS job_url,
    company_name, {company_id('company_name')} AS company_id, title, {clean('description')} AS description,
    department, employment_type, location_raw,
    CASE WHEN st IS NOT NULL THEN {city('lt', 'st')} END AS city,
    st AS state,
    CASE WHEN st IS NOT NULL THEN {postal('lt')} END AS postal_code,
    CASE WHEN lempty THEN false ELSE {remote('lt')} END AS is_remote,
    'US' AS country, CASE WHEN NOT bad_date THEN CAST(run_date - 3 AS DATE) END AS date_posted, run_date,
    {job_key('source', 'company_name', 'source_job_id', 'title')} AS job_key,
    CASE WHEN lempty THEN false WHEN st IS NOT NULL THEN true WHEN phrase THEN true ELSE {lenient} END AS is_us,
    CAST(CASE WHEN lempty THEN 0.0 WHEN st IS NOT NULL THEN 0.9 WHEN phrase THEN 0.7 ELSE {conf_else} END AS DOUBLE) AS confidence,
    is_portfolio
  FROM l2),
canon_r AS (SELECT *, CASE WHEN source_job_id IS NULL THEN 'Transform error: missing id'
  WHEN NOT is_us THEN 'Failed US location validation' END AS reason FROM canon)"""


def jobs_ctes() -> str:
    rf_names = [n for n, _ in ROLE_FAMILIES]
    rf_scores = [f"rf{i}" for i in range(len(ROLE_FAMILIES))]
    in_names = [n for n, _ in INDUSTRIES]
    in_scores = [f"in{i}" for i in range(len(INDUSTRIES))]
    rf_cols = ",\n    ".join(f"{hits('rt', ws)} * 10 + {hits('rd', ws)} AS rf{i}"
                             for i, (_, ws) in enumerate(ROLE_FAMILIES))
    in_cols = ",\n    ".join(f"{hits('iname', ws)} * 5 + {hits('idesc', ws)} AS in{i}"
                             for i, (_, ws) in enumerate(INDUSTRIES))
    rf_pick, _ = first_best(rf_names, rf_scores)
    in_pick, in_best = first_best(in_names, in_scores)
    return f"""{canon_ctes(True)},
v AS (SELECT * FROM canon_r WHERE reason IS NULL),
e1 AS (SELECT *, {clean('title', True)} AS rt, {clean('description', True)} AS rd,
              {clean("concat_ws(' ', title, description)")} AS sc,
              lower(company_name) AS iname, lower(substr(description, 1, 1000)) AS idesc FROM v),
e2 AS (SELECT *,
    {rf_cols},
    {in_cols},
    {skills_list('sc')} AS skills
  FROM e1),
e3 AS (SELECT *, {rf_pick} AS role_family, {in_pick} AS industry_tag,
              CASE WHEN {in_best} > 0 THEN least({in_best} / 10.0, 1.0) ELSE 0.0 END AS industry_confidence FROM e2),
jobs AS (SELECT * FROM e3 QUALIFY row_number() OVER (PARTITION BY run_date, job_key ORDER BY pos) = 1)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


# ---------------------------------------------------------------------- text

oracle("clean_text_pages", f"SELECT page_id, {clean('html')} AS clean FROM pages")
oracle("clean_text_lower_pages", f"SELECT page_id, {clean('html', True)} AS clean FROM pages")
oracle("normalize_whitespace_docs",
       f"SELECT doc_id, coalesce(trim(regexp_replace(text, {q(WS + '+')}, ' ', 'g')), '') AS normalized FROM documents")
oracle("keyword_counts", f"""
SELECT keyword, count(*) AS n FROM (
  SELECT unnest(list_filter(regexp_extract_all({clean('text', True)}, {q(TOKEN)}), lambda w: length(w) >= 3)) AS keyword
  FROM documents) GROUP BY keyword""")
oracle("state_abbrev", f"""
SELECT doc_id, nullif(regexp_extract(upper(text), {q('(?:^|' + NW + ')(' + '|'.join(CODES) + ')(?:' + NW + '|$)')}, 1), '')
  AS state_abbrev FROM documents""")

# ------------------------------------------------------------------ location

oracle("is_remote", with_(P, f"SELECT pos, {remote('location_raw')} AS is_remote FROM p"))
oracle("state_code", with_(P, f"SELECT pos, {state_code('location_raw')} AS state_code FROM p"))
oracle("city", with_(P + f",\nc AS (SELECT pos, location_raw, {state_code('location_raw')} AS st FROM p)",
                     f"SELECT pos, CASE WHEN st IS NULL THEN {city('location_raw', 'NULL')} "
                     f"ELSE {city('location_raw', 'st')} END AS city FROM c"))
oracle("postal_code", with_(P, f"SELECT pos, {postal('location_raw')} AS postal_code FROM p"))
for _strict, _name in ((True, "parse_location_strict"), (False, "parse_location_lenient")):
    oracle(_name, with_(canon_ctes(_strict, known=False),
                        "SELECT pos, city, state, postal_code, is_remote, is_us, round(confidence, 6) AS confidence "
                        "FROM canon"))
oracle("validate_us", with_(
    canon_ctes(True, known=False),
    "SELECT pos, (is_us AND confidence >= 0.7) AS valid_strict, "
    "(location_raw IS NOT NULL AND location_raw <> '') AS valid_lenient FROM canon"))

# L1-L5 and H1 over whole texts
oracle("is_remote_docs", f"SELECT doc_id, {remote('text')} AS is_remote FROM documents")
oracle("state_code_docs", f"SELECT doc_id, {state_code('text')} AS state_code FROM documents")
oracle("postal_code_docs", f"SELECT doc_id, {postal('text')} AS postal_code FROM documents")
oracle("parse_location_docs", f"""WITH t AS (SELECT doc_id, {strip('text')} AS lt, (text IS NULL OR text = '') AS lempty FROM documents),
s AS (SELECT *, CASE WHEN NOT lempty THEN {state_code('lt')} END AS st, {any_contains('lower(lt)', US_PHRASES)} AS phrase FROM t)
SELECT doc_id, CASE WHEN st IS NOT NULL THEN {city('lt', 'st')} END AS city, st AS state,
  CASE WHEN st IS NOT NULL THEN {postal('lt')} END AS postal_code, CASE WHEN lempty THEN false ELSE {remote('lt')} END AS is_remote,
  NOT lempty AND (st IS NOT NULL OR phrase) AS is_us,
  CAST(CASE WHEN lempty THEN 0.0 WHEN st IS NOT NULL THEN 0.9 WHEN phrase THEN 0.7 ELSE 0.0 END AS DOUBLE) AS confidence FROM s""")
oracle("text_hashes", "SELECT doc_id, sha256(text) AS text_hash, sha256(concat_ws('|', source, lang, text)) AS row_hash FROM documents")

# ---------------------------------------------------------------------- keys

def hash_key(src: str, company: str, jid: str, title: str) -> str:
    """Like ``job_key``; null parts are left out of the hashed text."""
    ch = f"substr(sha256({strip(f'lower({company})')}), 1, 8)"
    jh = f"substr(sha256(concat_ws('|', {strip(jid)}, {strip(f'lower({title})')})), 1, 8)"
    return f"{src} || '_' || {ch} || '_' || {jh}"


oracle("job_keys", with_(P, f"""SELECT pos, {hash_key('source', 'company_name', 'source_job_id', 'title')} AS job_key,
  {company_id('company_name')} AS company_id,
  sha256(concat_ws('|', source, source_job_id, title)) AS posting_hash FROM p"""))
oracle("company_ids", with_(P, f"""SELECT company_name, {company_id('company_name')} AS company_id,
  {company_id('company_name', q('example.com'))} AS company_id_with_domain
  FROM (SELECT DISTINCT company_name FROM p)"""))

# ----------------------------------------------------------------- canonical

CANON_OUT = ("pos, source, source_job_id, job_url, company_name, company_id, title, description, department, "
             "employment_type, location_raw, city, state, postal_code, is_remote, country, date_posted, run_date, job_key")
oracle("canonical_jobs", with_(canon_ctes(True), f"SELECT {CANON_OUT} FROM canon_r WHERE reason IS NULL"))
oracle("canonical_with_third_source", with_(canon_ctes(True, known=False), f"SELECT {CANON_OUT} FROM canon_r WHERE reason IS NULL"))
oracle("us_filter_valid", with_(canon_ctes(True), "SELECT pos, job_key, state, city, is_remote FROM canon_r WHERE reason IS NULL"))
oracle("us_filter_lenient", with_(canon_ctes(False), "SELECT pos, job_key, state, city, is_remote FROM canon_r WHERE reason IS NULL"))
oracle("us_rejects", with_(canon_ctes(True), """SELECT pos, company_name, source, coalesce(source_job_id, 'unknown') AS source_job_id,
  reason, CASE WHEN source_job_id IS NOT NULL THEN location_raw END AS raw_location, run_date FROM canon_r WHERE reason IS NOT NULL"""))
oracle("reject_counts", with_(canon_ctes(True), """SELECT run_date, source,
  count(*) FILTER (WHERE reason IS NULL) AS valid_jobs, count(*) FILTER (WHERE reason IS NOT NULL) AS rejected_jobs
  FROM canon_r GROUP BY ALL"""))
oracle("reject_counts_by_reason", with_(canon_ctes(True), """SELECT run_date, source, coalesce(reason, 'valid') AS status,
  count(*) AS n FROM canon_r GROUP BY ALL"""))

# -------------------------------------------------------------------- enrich

_P_CLEAN = P + f",\npc AS (SELECT * REPLACE (coalesce(title, '') AS title), {clean('description')} AS cdesc FROM p WHERE source IN ('greenhouse', 'lever'))"
_rf_expr = first_best(
    [n for n, _ in ROLE_FAMILIES],
    [f"({hits(clean('title', True), ws)} * 10 + {hits(clean('cdesc', True), ws)})" for _, ws in ROLE_FAMILIES],
)[0]
oracle("role_family", with_(_P_CLEAN, f"SELECT pos, {_rf_expr} AS role_family FROM pc"))
_in_scores = [f"({hits('lower(company_name)', ws)} * 5 + {hits('lower(substr(cdesc, 1, 1000))', ws)})"
              for _, ws in INDUSTRIES]
_in_pick, _in_best = first_best([n for n, _ in INDUSTRIES], _in_scores)
oracle("industry_tag", with_(_P_CLEAN, f"""SELECT pos, {_in_pick} AS industry_tag,
  round(CASE WHEN {_in_best} > 0 THEN least({_in_best} / 10.0, 1.0) ELSE 0.0 END, 6) AS confidence FROM pc"""))
oracle("skills", with_(_P_CLEAN, f"""SELECT pos, array_to_string({skills_list(clean("concat_ws(' ', title, cdesc)"))}, '|') AS skills
  FROM pc"""))
oracle("enrichment_coverage", with_(jobs_ctes(), """SELECT run_date, count(*) AS total_jobs,
  count(role_family) AS classified_jobs, count(*) FILTER (WHERE len(skills) > 0) AS jobs_with_skills,
  count(industry_tag) AS tagged_jobs FROM jobs GROUP BY run_date"""))

# -------------------------------------------------------------------- dedupe

oracle("dedupe_first", with_(canon_ctes(True), """SELECT job_key, pos, run_date FROM canon_r WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY run_date, job_key ORDER BY pos) = 1"""))
oracle("duplicates_removed", with_(canon_ctes(True), """SELECT count(*) AS rows_before, count(DISTINCT (run_date, job_key)) AS rows_after,
  count(*) - count(DISTINCT (run_date, job_key)) AS duplicates_removed FROM canon_r WHERE reason IS NULL"""))
oracle("latest_snapshot", with_(jobs_ctes(), """SELECT job_key, run_date, pos, title, state, array_to_string(skills, '|') AS skills
  FROM jobs QUALIFY row_number() OVER (PARTITION BY job_key ORDER BY run_date DESC, source, pos) = 1"""))
_POSTED = ", posted AS (SELECT * FROM canon_r WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY run_date, job_key ORDER BY pos) = 1)"
oracle("latest_snapshot_by_merges", with_(canon_ctes(True) + _POSTED, """SELECT job_key, run_date, pos, title, state
  FROM posted QUALIFY row_number() OVER (PARTITION BY job_key ORDER BY run_date DESC, source, pos) = 1"""))
oracle("tagged_runs_by_index", with_(canon_ctes(True) + _POSTED, """SELECT run_date, job_key, min(run_date) OVER (PARTITION BY job_key) AS first_run_date,
  run_date = min(run_date) OVER (PARTITION BY job_key) AS is_new FROM posted"""))
oracle("first_seen_after_rebuild", with_(canon_ctes(True) + _POSTED, """SELECT job_key, min(run_date) AS first_run_date FROM posted
  WHERE source = 'greenhouse' OR run_date <> (SELECT min(run_date) FROM posted WHERE run_date > (SELECT min(run_date) FROM posted)) GROUP BY job_key"""))
oracle("distinct_over_run_ranges", with_(canon_ctes(True) + _POSTED + ", days AS (SELECT DISTINCT run_date FROM posted)", """SELECT a.run_date AS since, b.run_date AS until,
  count(DISTINCT job_key) AS job_key, count(DISTINCT state) AS state, true AS close FROM days a JOIN days b ON a.run_date <= b.run_date
  JOIN posted p ON p.run_date BETWEEN a.run_date AND b.run_date GROUP BY ALL"""))
oracle("events_latest", """SELECT user_id, event_type, event_id, ts, round(value, 6) AS value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
_FIRST = ", f AS (SELECT job_key, min(run_date) AS first_run_date FROM jobs GROUP BY job_key)"
oracle("new_jobs", with_(jobs_ctes() + _FIRST,
                         "SELECT j.run_date, j.job_key FROM jobs j JOIN f USING (job_key) WHERE j.run_date = f.first_run_date"))
oracle("existing_jobs", with_(jobs_ctes() + _FIRST, """SELECT j.run_date, j.job_key, f.first_run_date FROM jobs j
  JOIN f USING (job_key) WHERE j.run_date <> f.first_run_date"""))
oracle("new_vs_existing_by_run", with_(jobs_ctes() + _FIRST, """SELECT j.run_date,
  count(*) FILTER (WHERE j.run_date = f.first_run_date) AS new_jobs,
  count(*) FILTER (WHERE j.run_date <> f.first_run_date) AS existing_jobs
  FROM jobs j JOIN f USING (job_key) GROUP BY j.run_date"""))
_RUNS = (", runs AS (SELECT run_date, lag(run_date) OVER (ORDER BY run_date) AS prev_run_date "
         "FROM (SELECT DISTINCT run_date FROM jobs))")
oracle("new_vs_previous_run", with_(jobs_ctes() + _RUNS, """,
cur AS (SELECT j.run_date, j.job_key, r.prev_run_date FROM jobs j JOIN runs r USING (run_date))
SELECT run_date, count(*) AS n, kind FROM (
  SELECT run_date, CASE WHEN EXISTS (SELECT 1 FROM jobs h WHERE h.run_date = cur.prev_run_date AND h.job_key = cur.job_key)
    THEN 'existing' ELSE 'new' END AS kind FROM cur) GROUP BY run_date, kind"""))

# ------------------------------------------------------------------- metrics

_EX = ", ex AS (SELECT run_date, role_family, state, unnest(skills) AS skill FROM jobs WHERE len(skills) > 0)"
oracle("skills_by_role_family", with_(jobs_ctes() + _EX, """SELECT run_date, role_family, skill, count(*) AS job_count
  FROM ex WHERE role_family IS NOT NULL GROUP BY ALL"""))
oracle("skills_by_state", with_(jobs_ctes() + _EX, """SELECT run_date, state, skill, count(*) AS job_count
  FROM ex WHERE state IS NOT NULL GROUP BY ALL"""))
oracle("top_skills", with_(jobs_ctes() + _EX, """SELECT run_date, skill, job_count,
  row_number() OVER (PARTITION BY run_date ORDER BY job_count DESC, skill) AS rank
  FROM (SELECT run_date, skill, count(*) AS job_count FROM ex GROUP BY ALL) QUALIFY rank <= 100"""))
oracle("skill_metric_sets", with_(jobs_ctes() + _EX, """
SELECT 'skills_by_role_family' AS metric, run_date, role_family, NULL AS state, skill, count(*) AS job_count
  FROM ex WHERE role_family IS NOT NULL GROUP BY run_date, role_family, skill
UNION ALL
SELECT 'skills_by_state', run_date, NULL, state, skill, count(*) FROM ex WHERE state IS NOT NULL GROUP BY run_date, state, skill
UNION ALL
SELECT 'top_skills', run_date, NULL, NULL, skill, count(*) FROM ex GROUP BY run_date, skill"""))
oracle("role_mix_by_industry", with_(jobs_ctes(), """SELECT run_date, industry_tag, role_family, count(*) AS job_count
  FROM jobs WHERE industry_tag IS NOT NULL AND role_family IS NOT NULL GROUP BY ALL"""))
oracle("summary_stats", with_(jobs_ctes(), """SELECT run_date, count(*) AS total_jobs,
  count(*) FILTER (WHERE source = 'greenhouse') AS greenhouse_jobs,
  count(*) FILTER (WHERE source = 'lever') AS lever_jobs,
  count(DISTINCT company_id) AS unique_companies,
  count(*) FILTER (WHERE is_remote) AS remote_jobs,
  count(DISTINCT state) AS states_covered,
  count(*) FILTER (WHERE len(skills) > 0) AS jobs_with_skills,
  count(industry_tag) AS jobs_with_industry FROM jobs GROUP BY run_date"""))
oracle("ingest_stats", with_(P, """SELECT run_date, count(DISTINCT (source, company_name)) AS companies_processed,
  count(*) AS total_jobs, count(*) FILTER (WHERE source = 'greenhouse') AS greenhouse_jobs,
  count(*) FILTER (WHERE source = 'lever') AS lever_jobs FROM p GROUP BY run_date"""))

# -------------------------------------------------------------------- trends

oracle("jobs_by_run", with_(jobs_ctes(), "SELECT run_date, count(*) AS total_jobs FROM jobs GROUP BY run_date"))
oracle("jobs_growth", with_(jobs_ctes(), """SELECT run_date, total_jobs, coalesce(lag(total_jobs) OVER (ORDER BY run_date), 0) AS prev_jobs,
  total_jobs - coalesce(lag(total_jobs) OVER (ORDER BY run_date), 0) AS jobs_growth
  FROM (SELECT run_date, count(*) AS total_jobs FROM jobs GROUP BY run_date)"""))


def _change(counts_sql: str, keys: str, value: str, change: str = "change") -> str:
    """Value per (keys, run) vs the previous run, missing = 0, over the
    union of (keys, run) present now or in the previous run."""
    key_list = [k.strip() for k in keys.split(",")]
    on = " AND ".join(f"c.{k} = s.{k}" for k in key_list)
    sel = ", ".join(f"coalesce(c.{k}, s.{k}) AS {k}" for k in key_list)
    return f"""{_RUNS},
cnt AS ({counts_sql}),
shifted AS (SELECT {', '.join('c.' + k for k in key_list)}, r.run_date, c.{value} AS prev_{value}
            FROM cnt c JOIN runs r ON c.run_date = r.prev_run_date)
SELECT {sel}, coalesce(c.run_date, s.run_date) AS run_date,
  coalesce(c.{value}, 0) AS {value}, coalesce(s.prev_{value}, 0) AS prev_{value},
  coalesce(c.{value}, 0) - coalesce(s.prev_{value}, 0) AS {change}
FROM cnt c FULL OUTER JOIN shifted s ON {on} AND c.run_date = s.run_date"""


oracle("skill_growth", with_(jobs_ctes() + _EX, _change(
    "SELECT skill, run_date, count(*) AS job_count FROM ex GROUP BY skill, run_date", "skill", "job_count")))
oracle("hiring_velocity", with_(jobs_ctes(), _change(
    "SELECT company_id, run_date, count(*) AS job_count FROM jobs GROUP BY company_id, run_date", "company_id", "job_count")))
oracle("role_mix_shift", "SELECT role_family, run_date, round(share, 6) AS share, round(prev_share, 6) AS prev_share, "
       "round(share_change, 6) AS share_change FROM (" + with_(jobs_ctes(), _change(
           "SELECT role_family, run_date, count(*) / any_value(t) AS share FROM (SELECT *, count(*) OVER (PARTITION BY run_date) AS t "
           "FROM jobs) WHERE role_family IS NOT NULL GROUP BY role_family, run_date", "role_family", "share", "share_change")) + ")")
oracle("remote_pct", with_(jobs_ctes(), """SELECT run_date, round(coalesce(count(*) FILTER (WHERE is_remote) / count(*), 0.0), 6) AS remote_pct
  FROM jobs GROUP BY run_date"""))
oracle("avg_jobs_per_company", with_(jobs_ctes(), """SELECT run_date, round(count(*) / count(DISTINCT company_id), 6) AS avg_jobs_per_company
  FROM jobs GROUP BY run_date"""))
oracle("jobs_with_skill", with_(jobs_ctes(), """SELECT run_date, count(*) FILTER (WHERE list_contains(skills, 'Python')) AS jobs_with_skill
  FROM jobs GROUP BY run_date"""))
oracle("skills_expanded", with_(jobs_ctes(), """SELECT job_key, run_date, unnest(CASE WHEN len(skills) = 0 THEN [NULL] ELSE skills END) AS skill
  FROM jobs"""))
oracle("top_companies", with_(jobs_ctes(), """SELECT run_date, company_name, job_count,
  row_number() OVER (PARTITION BY run_date ORDER BY job_count DESC, company_name) AS rank
  FROM (SELECT run_date, company_name, count(*) AS job_count FROM jobs GROUP BY ALL) QUALIFY rank <= 10"""))
oracle("jobs_by_state", with_(jobs_ctes(), """SELECT run_date, state, count(*) AS job_count FROM jobs
  WHERE state IS NOT NULL GROUP BY ALL"""))
oracle("top_cities", with_(jobs_ctes(), """SELECT run_date, city, state, job_count,
  row_number() OVER (PARTITION BY run_date ORDER BY job_count DESC, city, state) AS rank
  FROM (SELECT run_date, city, state, count(*) AS job_count FROM jobs WHERE city IS NOT NULL GROUP BY ALL) QUALIFY rank <= 10"""))
oracle("remote_by_state", with_(jobs_ctes(), """SELECT run_date, state, count(*) FILTER (WHERE is_remote) AS remote_jobs,
  count(*) FILTER (WHERE NOT is_remote) AS onsite_jobs FROM jobs WHERE state IS NOT NULL GROUP BY ALL"""))
oracle("state_hhi", with_(jobs_ctes(), """SELECT run_date, round(sum(share * share), 6) AS hhi FROM (
  SELECT run_date, job_count / sum(job_count) OVER (PARTITION BY run_date) AS share
  FROM (SELECT run_date, state, count(*) AS job_count FROM jobs WHERE state IS NOT NULL GROUP BY ALL)) GROUP BY run_date"""))
oracle("top_skills_per_family", with_(jobs_ctes() + _EX, """SELECT run_date, role_family, skill, job_count,
  row_number() OVER (PARTITION BY run_date, role_family ORDER BY job_count DESC, skill) AS rank
  FROM (SELECT run_date, role_family, skill, count(*) AS job_count FROM ex WHERE role_family IS NOT NULL GROUP BY ALL)
  QUALIFY rank <= 5"""))
_fam_cols = ", ".join(f"count(*) FILTER (WHERE role_family = {q(f)}) AS {family_column(f)}" for f, _ in ROLE_FAMILIES)
oracle("skill_family_matrix", with_(jobs_ctes() + _EX, f"""SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY job_count DESC, skill) AS rank
  FROM (SELECT run_date, skill, count(*) AS job_count, {_fam_cols} FROM ex GROUP BY run_date, skill) QUALIFY rank <= 20"""))
oracle("industry_share", with_(jobs_ctes(), """SELECT run_date, industry_tag, role_family, job_count,
  round(job_count / sum(job_count) OVER (PARTITION BY run_date, industry_tag), 6) AS share_of_industry,
  round(sum(job_count) OVER (PARTITION BY run_date, industry_tag) / sum(job_count) OVER (PARTITION BY run_date), 6)
    AS industry_share_of_run
  FROM (SELECT run_date, industry_tag, role_family, count(*) AS job_count FROM jobs
        WHERE industry_tag IS NOT NULL AND role_family IS NOT NULL GROUP BY ALL)"""))
oracle("eng_ratio", with_(jobs_ctes(), """SELECT run_date, eng_jobs, non_eng_jobs,
  round(CASE WHEN non_eng_jobs = 0 THEN NULL ELSE eng_jobs / non_eng_jobs END, 6) AS eng_ratio FROM (
  SELECT run_date, count(*) FILTER (WHERE role_family = 'Tech/Engineering') AS eng_jobs,
    count(*) FILTER (WHERE role_family IS NULL OR role_family <> 'Tech/Engineering') AS non_eng_jobs
  FROM jobs GROUP BY run_date)"""))
_SEEDS = ", seeds AS (SELECT DISTINCT company_name, is_portfolio FROM p)"
_PORT = _SEEDS + """, pj AS (SELECT run_date, company_name, count(*) AS job_count FROM jobs
  WHERE lower(trim(company_name)) IN (SELECT lower(trim(company_name)) FROM seeds WHERE is_portfolio) GROUP BY ALL)"""
oracle("portfolio_jobs", with_(jobs_ctes() + _PORT, "SELECT * FROM pj"))
oracle("benchmark_vs_market", with_(jobs_ctes() + _PORT, """
SELECT m.run_date, round(market_avg, 6) AS market_avg, round(portfolio_avg, 6) AS portfolio_avg,
  round(portfolio_avg / market_avg, 6) AS portfolio_vs_market
FROM (SELECT run_date, count(*) / count(DISTINCT company_id) AS market_avg FROM jobs GROUP BY run_date) m
LEFT JOIN (SELECT run_date, sum(job_count) / count(*) AS portfolio_avg FROM pj GROUP BY run_date) pa USING (run_date)"""))
oracle("dim_company", with_(jobs_ctes(), "SELECT company_id, min(company_name) AS company_name FROM jobs GROUP BY company_id"))
oracle("dim_date", with_(jobs_ctes(), """SELECT d AS date, d IN (SELECT run_date FROM jobs) AS has_run,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(weekofyear(d) AS INTEGER) AS week
  FROM (SELECT CAST(unnest(generate_series(min(run_date), max(run_date), INTERVAL 1 DAY)) AS DATE) AS d FROM jobs)"""))

# -------------------------------------------------------------------- boards

_GH_TOKEN = r"boards\.greenhouse\.io/([a-zA-Z0-9_-]+)"
_LV_TOKEN = r"jobs\.lever\.co/([a-zA-Z0-9_-]+)"


def gh_tok(u: str = "url") -> str:
    return f"nullif(regexp_extract({u}, {q(_GH_TOKEN)}, 1), '')"


def lv_tok(u: str = "url") -> str:
    return f"nullif(regexp_extract({u}, {q(_LV_TOKEN)}, 1), '')"


def is_gh(u: str = "url") -> str:
    return f"coalesce(contains(lower({u}), 'boards.greenhouse.io'), false)"


def is_lv(u: str = "url") -> str:
    return f"coalesce(contains(lower({u}), 'lever.co'), false)"


def ats_of(u: str = "url") -> str:
    return (f"CASE WHEN {is_gh(u)} AND {gh_tok(u)} IS NOT NULL THEN 'greenhouse' "
            f"WHEN {is_lv(u)} AND {lv_tok(u)} IS NOT NULL THEN 'lever' END")


def ident_of(ats: str, u: str = "url") -> str:
    return f"CASE WHEN {ats} = 'greenhouse' THEN {gh_tok(u)} WHEN {ats} = 'lever' THEN {lv_tok(u)} END"


def _title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '[a-zA-Z]+|[^a-zA-Z]+'), "
            f"lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '')")




oracle("detect_ats", with_(B, f"""SELECT page_id, url, {is_gh()} AS is_greenhouse, {is_lv()} AS is_lever,
  {gh_tok()} AS greenhouse_token, {lv_tok()} AS lever_company, {ats_of()} AS ats FROM b"""))
oracle("board_identifiers", with_(B, f"""SELECT page_id, ats_type, {ident_of('ats_type')} AS identifier,
  CASE WHEN url IS NULL OR url = '' THEN 'url_missing'
       WHEN ats_type = 'greenhouse' THEN CASE WHEN {gh_tok()} IS NULL THEN 'greenhouse_token_missing' END
       WHEN ats_type = 'lever' THEN CASE WHEN {lv_tok()} IS NULL THEN 'lever_company_missing' END
       ELSE 'ats_unsupported' END AS error FROM b"""))
_DISC_CTES = f"d AS (SELECT page_id, url, {ats_of()} AS ats_type FROM b), dd AS (SELECT *, {ident_of('ats_type')} AS identifier FROM d WHERE ats_type IS NOT NULL)"
_DISC = B + ", " + _DISC_CTES
oracle("discovered_urls", with_(_DISC, f"""SELECT page_id, {_title("replace(identifier, '-', ' ')")} AS company_name,
  url AS careers_url, ats_type, 'url_pattern' AS discovery_method, CAST(0.95 AS DOUBLE) AS confidence FROM dd"""))
_CAND = B + """, seeds AS (SELECT DISTINCT domain, company_name FROM b),
cd AS (SELECT domain, company_name, regexp_replace(CASE WHEN starts_with(dl, 'http') THEN regexp_replace(dl, 'https?://', '', 'g') ELSE dl END, '/+$', '') AS cdom
       FROM (SELECT *, """ + strip("lower(domain)") + """ AS dl FROM seeds)),
cands AS (SELECT domain, company_name, u.pos, u.url FROM cd, LATERAL (SELECT * FROM (VALUES
  (0, 'https://boards.greenhouse.io/' || replace(cdom, '.', '')),
  (1, 'https://boards.greenhouse.io/' || replace(lower(company_name), ' ', '')),
  (2, 'https://jobs.lever.co/' || replace(cdom, '.', '')),
  (3, 'https://jobs.lever.co/' || replace(lower(company_name), ' ', '')),
  (4, 'https://jobs.lever.co/' || replace(lower(company_name), ' ', '-'))) t(pos, url)) u)"""
oracle("candidate_urls", with_(_CAND, "SELECT domain, company_name, pos, url FROM cands"))
_PROBES = """, probes AS (SELECT url, CASE WHEN bool_or(probe_status = 200) THEN 200 ELSE min(probe_status) END AS status FROM (
  SELECT regexp_extract(url, '^(https?://[^/?#]+/[^/?#]+)', 1) AS url, probe_status FROM b) WHERE url <> '' GROUP BY url)"""
oracle("first_board_hit", with_(_CAND + _PROBES, f"""SELECT domain, company_name, url AS careers_url, {ats_of()} AS ats_type,
  'subdomain_probe' AS discovery_method, CAST(0.85 AS DOUBLE) AS confidence
  FROM cands WHERE url IN (SELECT url FROM probes WHERE status = 200) AND ({ats_of()}) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY domain, company_name ORDER BY pos) = 1"""))
_PB = (f", pb AS (SELECT DISTINCT {ats_of('job_url')} AS ats_type, {ident_of(ats_of('job_url'), 'job_url')} "
       f"AS identifier FROM canon_r WHERE reason IS NULL)")
oracle("verified_boards", with_(canon_ctes(True) + ",\n" + B + ", " + _DISC_CTES + _PB, """SELECT page_id, ats_type, identifier FROM dd
  WHERE (ats_type, identifier) IN (SELECT (ats_type, identifier) FROM pb WHERE identifier IS NOT NULL)"""))
oracle("job_urls", with_(P, """SELECT pos, 'https://boards.greenhouse.io/' || company_slug || '/jobs/' || source_job_id AS greenhouse_url,
  'https://jobs.lever.co/' || company_slug || '/' || source_job_id AS lever_url FROM p"""))

oracle("ingest_outcomes", with_(B, f"""SELECT ats_type, count(*) AS companies,
  count(*) FILTER (WHERE NOT (ats_type IN ('greenhouse', 'lever') AND ({ident_of('ats_type')}) IS NULL)) AS companies_processed,
  count(*) FILTER (WHERE ats_type IN ('greenhouse', 'lever') AND ({ident_of('ats_type')}) IS NULL) AS companies_failed,
  count(*) FILTER (WHERE NOT coalesce(ats_type IN ('greenhouse', 'lever'), false)) AS unknown_ats FROM b GROUP BY ats_type"""))

oracle("ingest_summary", with_(canon_ctes(True) + ",\n" + B, f""",
n AS (SELECT {ats_of('job_url')} AS a, {ident_of(ats_of('job_url'), 'job_url')} AS i, count(*) AS n FROM canon_r
      WHERE reason IS NULL GROUP BY ALL),
j AS (SELECT ats_type, ident, n, coalesce(ats_type IN ('greenhouse', 'lever'), false) AND ident IS NULL AS failed
      FROM (SELECT ats_type, {ident_of('ats_type')} AS ident FROM b) s LEFT JOIN n ON n.a = s.ats_type AND n.i = s.ident)
SELECT ats_type, count(*) AS companies, count(*) FILTER (WHERE NOT failed) AS companies_processed,
  count(*) FILTER (WHERE failed) AS companies_failed,
  count(*) FILTER (WHERE NOT failed AND n IS NULL) AS companies_without_postings,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS total_jobs FROM j GROUP BY ats_type"""))
oracle("star_by_week", with_(jobs_ctes(), """SELECT company_id, any_value(cn) AS company_name, CAST(year(run_date) AS INTEGER) AS year,
  CAST(weekofyear(run_date) AS INTEGER) AS week, count(*) AS job_count, count(*) FILTER (WHERE is_remote) AS remote_jobs,
  count(DISTINCT run_date) AS runs
  FROM (SELECT *, min(company_name) OVER (PARTITION BY company_id) AS cn FROM jobs) GROUP BY company_id, year(run_date), weekofyear(run_date)"""))

# reports from facts give what they give from postings
for _name in ("summary_stats", "top_skills", "skill_growth", "skill_family_matrix"):
    oracle(f"{_name}_from_facts", ORACLES[_name])
