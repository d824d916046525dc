"""Dictionary-driven enrichment: role family, skills, industry.

All three are narrow projections: each row is scored against a dictionary
baked into the plan, so there is no join, no shuffle and no Python in the hot
path.

Layout of the plan (``enrich``):

1. one pass over each text finds the dictionary keywords that can be in it, and
   only these are searched (``functions.keyword_scan``). The finds are yielded as one struct through
   ``inline``, so no later projection or filter can make the scan run again;
2. category scores count the finds by category. They are materialised as
   integer columns before the pick, because the pick names the score array
   several times and higher-order functions get no common subexpression
   elimination. The winner is the first category holding the maximum.

Role families and industries count keywords as substrings, skills as whole
words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries import (
    INDUSTRIES, INDUSTRY_CONFIDENCE_DIVISOR, INDUSTRY_DESC_CHARS,
    INDUSTRY_DESC_WEIGHT, INDUSTRY_DOMAIN_WEIGHT, INDUSTRY_NAME_WEIGHT,
    ROLE_DESC_WEIGHT, ROLE_FAMILIES, ROLE_TITLE_WEIGHT, SKILLS, Taxonomy, flatten,
)
from ..functions.keyword_scan import count_found, find_keywords, find_words, let
from ..functions.patterns import word_bounded
from ..functions.text import _col, clean_text, normalize_whitespace


def _lowered(taxonomy: Taxonomy) -> list[str]:
    return [w.lower() for w in flatten(taxonomy)]


def with_found(df: DataFrame, found: dict[str, Column]) -> DataFrame:
    """``df`` and the columns ``found``, computed once per row."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in found.items()]))))


def first_best(names: list[str], scores: list[Column]) -> tuple[Column, Column]:
    """(name of the first category with the maximum score, maximum); null
    name when every score is 0."""
    arr = F.array(*scores)
    best = F.array_max(arr)
    pick = F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position(arr, best).cast("int"))
    return F.when(best > 0, pick), best


#: letters outside ASCII that match an ASCII letter when case is ignored
_FOLDED, _FOLDS = "ſKİı", "skii"


def fold_for_probe(text: Column) -> Column:
    """Lower-case, after mapping the four non-ASCII letters whose
    case-insensitive match class contains an ASCII letter: an ASCII skill then
    occurs in the result where it occurs in the text, case ignored."""
    odd = (F.octet_length(text) > F.char_length(text)) & text.rlike(f"[{_FOLDED}]")
    return F.lower(F.when(odd, F.translate(text, _FOLDED, _FOLDS)).otherwise(text))


def _literal(skill: str, case_sensitive: bool) -> str:
    return skill if case_sensitive else skill.lower()


def skills_found(cleaned: Column, skills: list[str], case_sensitive: bool = False) -> Column:
    """The literals (see ``skills_of``) that are whole words of ``cleaned``."""
    plain = [s for s in skills if case_sensitive or s.isascii()]
    found = find_words(cleaned if case_sensitive else fold_for_probe(cleaned), [_literal(s, case_sensitive) for s in plain])
    others = [s for s in dict.fromkeys(skills) if s not in plain]
    if others:  # lower-casing may change their length: searched one by one
        specs = F.array(*[F.struct(F.lit(s.lower()).alias("k"), F.lit("(?iu)" + word_bounded(s)).alias("rx")) for s in others])
        more = let(cleaned, lambda t: F.transform(F.filter(specs, lambda s: F.rlike(t, s["rx"])), lambda s: s["k"]))
        found = F.array_union(found, more)
    return found


def skills_of(found: Column, skills: list[str], case_sensitive: bool = False) -> Column:
    """The sorted distinct skills of the literals ``found`` (a column)."""
    specs = F.array(*[F.struct(F.lit(s).alias("skill"), F.lit(_literal(s, case_sensitive)).alias("k")) for s in dict.fromkeys(skills)])
    return F.array_sort(F.transform(F.filter(specs, lambda s: F.array_contains(found, s["k"])), lambda s: s["skill"]))


def _role_scores(title: Column, description: Column, taxonomy: Taxonomy) -> list[Column]:
    """Scores by category from the keywords found in the two texts."""
    lower = [[w.lower() for w in ws] for _, ws in taxonomy]
    return [count_found(title, ws) * ROLE_TITLE_WEIGHT + count_found(description, ws) * ROLE_DESC_WEIGHT for ws in lower]


def _industry_scores(found: dict[str, Column], mapping: Taxonomy) -> list[Column]:
    weight = {"name": INDUSTRY_NAME_WEIGHT, "domain": INDUSTRY_DOMAIN_WEIGHT, "description": INDUSTRY_DESC_WEIGHT}
    out = []
    for _, ws in mapping:
        parts = [count_found(c, [w.lower() for w in ws]) * weight[k] for k, c in found.items()]
        out.append(reduce(lambda a, b: a + b, parts))
    return out


def _confidence(best: Column) -> Column:
    return F.when(best > 0, F.least(best / F.lit(INDUSTRY_CONFIDENCE_DIVISOR), F.lit(1.0))).otherwise(F.lit(0.0))


# ---------------------------------------------------------------- column API

def classify_role_family(title: Column | str, description: Column | str,
                         taxonomy: Taxonomy = ROLE_FAMILIES) -> Column:
    words, names = _lowered(taxonomy), [n for n, _ in taxonomy]
    found = F.struct(find_keywords(clean_text(title, True), words).alias("t"), find_keywords(clean_text(description, True), words).alias("d"))
    return let(found, lambda f: first_best(names, _role_scores(f["t"], f["d"], taxonomy))[0])


def extract_skills(text: Column | str, taxonomy: Taxonomy = SKILLS, case_sensitive: bool = False) -> Column:
    skills = flatten(taxonomy)
    found = let(clean_text(text), lambda t: skills_found(t, skills, case_sensitive))
    return let(found, lambda f: skills_of(f, skills, case_sensitive))


def _industry_found(name: Column, domain: Column | None, description: Column | None, mapping: Taxonomy,
                    description_chars: int) -> dict[str, Column]:
    texts = {"name": name, "domain": domain, "description": None if description is None else F.substring(description, 1, description_chars)}
    return {k: find_keywords(F.lower(c), _lowered(mapping)) for k, c in texts.items() if c is not None}


def tag_industry(company_name: Column | str, company_domain: Column | str | None,
                 description: Column | str | None, mapping: Taxonomy = INDUSTRIES,
                 description_chars: int = INDUSTRY_DESC_CHARS) -> Column:
    """Struct (industry_tag, confidence): 5 per keyword in the name, 5 in the
    domain, 1 in the first ``description_chars`` description characters (1000
    is the original's rule)."""
    dom, desc = (_col(c) if c is not None else None for c in (company_domain, description))
    found = _industry_found(_col(company_name), dom, desc, mapping, description_chars)

    def scored(f: Column) -> Column:
        tag, best = first_best([n for n, _ in mapping], _industry_scores({k: f[k] for k in found}, mapping))
        return F.struct(tag.alias("industry_tag"), _confidence(best).alias("confidence"))

    return let(F.struct(*[c.alias(k) for k, c in found.items()]), scored)


# ------------------------------------------------------------- DataFrame API


def _score_cols(prefix: str, scores: list[Column]) -> list[Column]:
    return [sc.alias(f"{prefix}{i}") for i, sc in enumerate(scores)]


def _pick(prefix: str, names: list[str]) -> tuple[Column, Column]:
    return first_best(names, [F.col(f"{prefix}{i}") for i in range(len(names))])


def with_role_family(df: DataFrame, title: str = "title", description: str = "description",
                     out: str = "role_family", taxonomy: Taxonomy = ROLE_FAMILIES, cleaned: bool = False) -> DataFrame:
    """``cleaned``: the description already went through ``clean_text``, which
    is idempotent, so only its case is folded here."""
    body = F.coalesce(F.lower(F.col(description)), F.lit("")) if cleaned else clean_text(description, True)
    words = _lowered(taxonomy)
    staged = with_found(df, {"__rt": find_keywords(clean_text(title, True), words), "__rd": find_keywords(body, words)})
    scored = staged.select("*", *_score_cols("__rf", _role_scores(F.col("__rt"), F.col("__rd"), taxonomy)))
    name, _ = _pick("__rf", [n for n, _ in taxonomy])
    return scored.select(*[c for c in df.columns if c != out], name.alias(out))


def cleaned_title_and_body(title: str, body: str) -> Column:
    """``clean_text`` of title and body, where the body is cleaned already: only
    a title with a tag can change it once more."""
    both = F.concat_ws(" ", title, body)
    return F.when(F.col(title).contains("<"), clean_text(both)).otherwise(
        F.trim(F.concat_ws(" ", normalize_whitespace(title), F.col(body))))


def with_skills(df: DataFrame, text: Column, out: str = "skills", taxonomy: Taxonomy = SKILLS,
                cleaned: bool = False) -> DataFrame:
    skills = flatten(taxonomy)
    staged = with_found(df, {"__sf": let(text if cleaned else clean_text(text), lambda t: skills_found(t, skills))})
    return staged.select(*[c for c in df.columns if c != out], skills_of(F.col("__sf"), skills).alias(out))


def with_industry(df: DataFrame, name: str = "company_name", domain: str | None = None,
                  description: str | None = "description", out: str = "industry",
                  mapping: Taxonomy = INDUSTRIES, description_chars: int = INDUSTRY_DESC_CHARS) -> DataFrame:
    """Struct ``out`` (industry_tag, confidence); the description counts with
    its first ``description_chars`` characters (1000 is the original's rule)."""
    found = _industry_found(F.col(name), F.col(domain) if domain is not None else None,
                            F.col(description) if description is not None else None, mapping, description_chars)
    staged = with_found(df, {f"__in_{k}": c for k, c in found.items()})
    scores = _industry_scores({k: F.col(f"__in_{k}") for k in found}, mapping)
    scored = staged.select("*", *_score_cols("__ind", scores))
    tag, best = _pick("__ind", [n for n, _ in mapping])
    res = F.struct(tag.alias("industry_tag"), _confidence(best).alias("confidence"))
    return scored.select(*df.columns, res.alias(out))


def _unset(c: Column) -> Column:
    return c.isNull() | (c == "")


def _filled(jobs: DataFrame, scored: DataFrame, column: str, value: Column, empty: Column) -> DataFrame:
    """``jobs``' columns, ``column`` taken from ``value`` where it is empty."""
    new = F.when(empty, value).otherwise(F.col(column)).alias(column)
    return scored.select(*[new if c == column else F.col(c) for c in jobs.columns])


def enrich_role_family(jobs: DataFrame, taxonomy: Taxonomy = ROLE_FAMILIES, cleaned: bool = False) -> DataFrame:
    """Fill ``role_family`` where it is empty; other columns stay."""
    scored = with_role_family(jobs, out="__family", taxonomy=taxonomy, cleaned=cleaned)
    return _filled(jobs, scored, "role_family", F.col("__family"), _unset(F.col("role_family")))


def enrich_skills(jobs: DataFrame, taxonomy: Taxonomy = SKILLS, cleaned: bool = False) -> DataFrame:
    """Fill ``skills`` (of title + description) where they are empty."""
    both = cleaned_title_and_body("title", "description") if cleaned else F.concat_ws(" ", "title", "description")
    scored = with_skills(jobs, both, out="__skills", taxonomy=taxonomy, cleaned=cleaned)
    cur = F.col("skills")
    return _filled(jobs, scored, "skills", F.col("__skills"), cur.isNull() | (F.size(cur) == 0))


def enrich_industry(jobs: DataFrame, mapping: Taxonomy = INDUSTRIES,
                    description_chars: int = INDUSTRY_DESC_CHARS) -> DataFrame:
    """Fill ``industry_tag`` (name, domain, first description characters)
    where it is empty; the confidence is not kept."""
    scored = with_industry(jobs, domain="company_domain", out="__industry", mapping=mapping, description_chars=description_chars)
    return _filled(jobs, scored, "industry_tag", F.col("__industry.industry_tag"), _unset(F.col("industry_tag")))


def enrich(jobs: DataFrame, role_taxonomy: Taxonomy = ROLE_FAMILIES, skills: Taxonomy = SKILLS,
           industries: Taxonomy = INDUSTRIES, cleaned: bool = False,
           description_chars: int = INDUSTRY_DESC_CHARS) -> DataFrame:
    """Fill ``role_family``, ``skills`` and ``industry_tag`` where they are
    empty. ``cleaned``: descriptions already went through ``clean_text``."""
    out = enrich_role_family(jobs, role_taxonomy, cleaned)
    out = enrich_skills(out, skills, cleaned)
    return enrich_industry(out, industries, description_chars)


def enrichment_coverage(jobs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of jobs classified, with skills, and tagged."""
    return jobs.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count("role_family").alias("classified_jobs"),
        F.count_if(F.size("skills") > 0).alias("jobs_with_skills"),
        F.count("industry_tag").alias("tagged_jobs"),
    )
