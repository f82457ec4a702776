"""Column functions for role families and for labels meant to be read."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import rules as R
from .text import let, literal_map, replace_all, squash, text

_EDGES = r"^[, .;:|\\/-]+|[, .;:|\\/-]+$"


def clean_role(c: Column | str) -> Column:
    """Role title without gender marks, reference numbers, mode marks and edge punctuation."""
    t = F.btrim(replace_all(F.lower(F.btrim(text(c))), [("(?U)" + p, n) for p, n in R.ROLE_NOISE]))
    return F.btrim(F.regexp_replace(t, _EDGES, ""))


def role_family(cleaned: Column, families=R.ROLE_FAMILIES) -> Column:
    """First family whose pattern occurs in a cleaned title."""
    hits = [F.when(cleaned.rlike("(?iU)" + pattern), F.lit(name)) for name, pattern in families]
    return F.when(cleaned == "", F.lit(R.UNKNOWN_FAMILY)).otherwise(F.coalesce(*hits, F.lit(R.UNKNOWN_FAMILY)))


def employer_key(c: Column | str) -> Column:
    """Employer name without legal form, leading article and edge punctuation."""
    n = F.regexp_replace(F.lower(F.btrim(text(c))), R.LEGAL_SUFFIX, "")
    n = F.regexp_replace(F.regexp_replace(n, r"(?i)^the\s+", ""), r"\s+", " ")
    n = F.btrim(F.regexp_replace(n, _EDGES, ""))
    return F.when(n == "", F.lit(R.UNKNOWN_EMPLOYER)).otherwise(n)


def employer_label(key: Column | str, overrides=R.EMPLOYER_OVERRIDES) -> Column:
    """Readable employer: capitalised words, house style for legal forms, then the override table."""
    key = F.col(key) if isinstance(key, str) else key
    styled = replace_all(F.initcap(key), R.EMPLOYER_CASE_RULES)
    known = literal_map(overrides)
    named = let(styled, lambda s: F.coalesce(F.try_element_at(known, s), s))
    return (F.when(key == R.LONG_TAIL, F.lit(R.LONG_TAIL_LABEL))
            .when(key == R.UNKNOWN_EMPLOYER, F.lit(R.UNKNOWN_EMPLOYER_LABEL)).otherwise(named))


def title_case(c: Column) -> Column:
    """Every run of letters starts with a capital, as in "O'Brien" and "3D"."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(
        runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.right(r, F.length(r) - 1)))), "")


def shorten_at_word(c: Column, limit: int) -> Column:
    """At most `limit` characters: cut at the last blank, or hard when that would lose more than half."""
    hard = F.left(c, F.lit(limit - 1))
    word = F.regexp_replace(hard, r" [^ ]*$", "")
    return (F.when(F.length(c) <= limit, c)
            .when(F.length(word) < limit // 2, F.concat(hard, F.lit("…"))).otherwise(F.concat(word, F.lit("…"))))


def shorten_hard(c: Column, limit: int) -> Column:
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.left(c, F.lit(limit - 1)), F.lit("…")))


def display_label(c: Column | str, kind: str) -> Column:
    """Table label of a fact value; `kind` is role, company, location or skill."""
    s = squash(text(c))
    if kind == "company":
        s = replace_all(title_case(s), R.DISPLAY_TOKEN_CASE)
        return squash(F.regexp_replace(s, rf"(?i)(\s*,?\s*({R.DISPLAY_LEGAL_FORMS})\s*)+$", ""))
    if kind == "role":
        s = title_case(squash(replace_all(s, [("(?U)" + p, n) for p, n in R.ROLE_DISPLAY_RULES])))
        return let(s, lambda v: shorten_at_word(v, R.ROLE_LABEL_MAX))
    return title_case(s)


def chart_label(c: Column | str, kind: str) -> Column:
    shorten = shorten_at_word if kind in ("role", "company") else shorten_hard
    return let(display_label(c, kind), lambda v: shorten(v, R.CHART_LABEL_MAX))
