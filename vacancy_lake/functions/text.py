"""Column functions that clean titles, employers, places, markup and work modes.

All of them stay on the JVM except the rare-entity branch of `html_to_text`. Patterns carry `(?U)` so that
Java reads `\\s`, `\\w` and `\\b` the Unicode way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from . import rules as R

_SPACE = r"\s\x1c-\x1f"
_EDGE = _SPACE + r".,;:|/\\-"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name an intermediate value: it is computed once however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank."""
    return F.regexp_replace(c, rf"(?U)[{_SPACE}]+", " ")


def squash(c: Column) -> Column:
    return F.btrim(squeeze(c))


def edge_trim(c: Column) -> Column:
    """Drop blanks and punctuation from both ends."""
    return F.regexp_replace(c, rf"(?U)^[{_EDGE}]+|[{_EDGE}]+$", "")


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lits(values) -> Column:
    """A constant array of strings, as one expression."""
    return F.expr(f"CAST(array({', '.join(map(_quoted, values))}) AS array<string>)")


def literal_map(items: Mapping[str, str | tuple[str, ...]]) -> Column:
    """A small dictionary as a constant column; sized by the rule object, not by data."""
    if not items:
        return F.expr("CAST(map() AS map<string,string>)")
    return F.expr("map(" + ", ".join(
        f"{_quoted(k)}, " + (_quoted(v) if isinstance(v, str) else f"array({', '.join(map(_quoted, v))})")
        for k, v in items.items()) + ")")


def lookup(items: Mapping[str, str], key: Column) -> Column:
    return F.try_element_at(literal_map(items), key)


def replace_all(c: Column, pairs) -> Column:
    for pattern, new in pairs:
        c = F.regexp_replace(c, pattern, new)
    return c


def normalize_title(c: Column | str) -> Column:
    """Lower-case title without gender marks, edge punctuation and stray slashes."""
    t = squash(text(c))
    t = F.regexp_replace(t, r"(?i) ?\( ?[mfwd] ?/ ?[mfwd] ?/ ?[mfwd] ?\)", " ")
    t = edge_trim(squash(t))
    return F.lower(squash(F.regexp_replace(t, " ?/ ", " ")))


def enrich_title(title: Column | str, category_tag: Column | str) -> Column:
    """Append a telling category tag to a normalised title that is one word or visibly cut off."""
    title, tag = text(title), F.lower(squash(text(category_tag)))
    words = F.split(title, " ")
    short = (F.size(words) == 1) | (
        (F.size(words) == 2) & F.get(words, F.lit(1)).isin(*R.TITLE_FRAGMENT_SECOND_WORDS))
    usable = (title != "") & (tag != "") & ~tag.isin(*R.GENERIC_CATEGORY_TAGS)
    return F.when(short & usable, F.concat(title, F.lit(" - "), tag)).otherwise(title)


def normalize_company(c: Column | str) -> Column:
    """Lower-case employer: bars to blanks, leading article dropped from longer names, edges trimmed."""
    n = F.lower(squeeze(F.replace(squash(text(c)), F.lit("|"), F.lit(" "))))
    n = F.when(n.startswith("the ") & (F.length(n) > 8), F.btrim(F.regexp_replace(n, "^the ", ""))).otherwise(n)
    return F.btrim(edge_trim(n))


def _segments(c: Column) -> Column:
    parts = F.transform(F.split(c, ","), lambda s: edge_trim(squeeze(s)))
    return F.filter(parts, lambda s: s != "")


def _drop_adjacent_repeats(parts: Column) -> Column:
    return let(parts, lambda p: F.filter(p, lambda s, i: (i == 0) | (s != F.get(p, i - 1))))


def canonical_place(location: Column, places: R.PlaceRules) -> Column:
    """"city, state", "state, country" or the country alone, for locations of the country of `places`."""
    cities, aliases = literal_map(places.cities), literal_map(places.aliases)
    states, country = lits(places.states), F.lit(places.country)

    def is_state(s: Column) -> Column:
        return F.array_contains(states, s)

    def is_country(s: Column) -> Column:
        return s.isin(*places.country_forms)

    def with_parent(s: Column, otherwise: Column) -> Column:
        return F.coalesce(
            F.when(is_state(s), F.concat_ws(", ", s, country)),
            F.concat(s, F.lit(", "), F.try_element_at(cities, s)),
            otherwise)

    def shape(p: Column) -> Column:
        first, second = F.get(p, F.lit(0)), F.get(p, F.lit(1))
        last, mid, low = (F.get(p, F.size(p) - k) for k in (1, 2, 3))
        one = F.when(is_country(first), country).otherwise(with_parent(first, first))
        two = F.when(is_country(second), with_parent(first, F.concat_ws(", ", first, country)))
        more = F.when(is_country(last) & is_state(mid) & ~is_state(low), F.concat_ws(", ", low, mid))
        return F.coalesce(
            F.when(F.size(p) == 1, one), F.when(F.size(p) == 2, two), F.when(F.size(p) > 2, more),
            F.array_join(p, ", "))

    def known(s: Column) -> Column:
        return s.isin(*places.context_forms) | is_state(s) | F.try_element_at(cities, s).isNotNull()

    def decide(p: Column) -> Column:
        renamed = F.transform(p, lambda s: F.coalesce(F.try_element_at(aliases, s), s))
        return F.when(F.exists(p, known), let(_drop_adjacent_repeats(renamed), shape))

    return F.coalesce(let(_segments(location), decide), location)


def normalize_location(c: Column | str, places: R.PlaceRules | None = R.PlaceRules()) -> Column:
    """Comma segments cleaned, adjacent repeats dropped, known spellings unified.

    When the first two of three or more segments are equal, only that segment is kept.
    """
    parts = _segments(F.lower(squash(text(c))))
    parts = let(parts, lambda p: F.when((F.size(p) >= 3) & (F.get(p, F.lit(0)) == F.get(p, F.lit(1))),
                                        F.slice(p, 1, 1)).otherwise(p))
    joined = F.array_join(_drop_adjacent_repeats(parts), ", ")
    out = let(joined, lambda v: F.coalesce(lookup(R.LOCATION_ALIASES, v), v))
    if places is None:
        return out
    return let(out, lambda v: F.when(v != "", canonical_place(v, places)).otherwise(v))


def resolve_area(display: Column | str, area: Column | str) -> Column:
    """Location text from a display name or, when that is only a country, from the area hierarchy."""
    area = F.col(area) if isinstance(area, str) else area
    shown = squash(text(display))
    levels = F.filter(F.transform(F.coalesce(area, F.array().cast("array<string>")), lambda a: squash(text(a))),
                      lambda a: a != "")

    def pick(a: Column) -> Column:
        n = F.size(a)
        first, last, parent = F.get(a, F.lit(0)), F.get(a, n - 1), F.get(a, n - 2)
        country_only = F.lower(shown).isin(*R.COUNTRY_DISPLAY_NAMES)
        deep = F.when(n >= 3, F.concat_ws(", ", last, parent))
        return F.coalesce(
            F.when(country_only, F.coalesce(
                deep,
                F.when((n == 2) & F.lower(first).isin(*R.COUNTRY_FIRST), last),
                F.when(n == 2, F.concat_ws(", ", last, first)))),
            F.when(shown != "", shown),
            deep,
            F.when(n == 2, F.concat_ws(", ", last, first)),
            F.when(n == 1, first),
            F.lit(""))

    return let(levels, pick)


_COMMON_ENTITY = "|".join(name for name, _ in R.HTML_ENTITIES)
_RARE_ENTITY = rf"&(?!({_COMMON_ENTITY});)(#|[A-Za-z])"


def _unescape_rare(c: Column) -> Column:
    # Defined here so that it ships by value: executors need no copy of this package.
    @F.pandas_udf(StringType())
    def unescape(s: pd.Series) -> pd.Series:
        import html

        return s.map(html.unescape, na_action="ignore")

    return unescape(c)


def html_to_text(c: Column | str, rare_entities: bool = True) -> Column:
    """Markup to plain text: entities resolved, script and style bodies and tags dropped, blanks collapsed.

    Only rows holding an entity outside the common set travel to Python; for all others the Arrow column is
    NULL. `rare_entities=False` keeps the plan free of Python.
    """
    raw = text(c)
    native = raw
    for name, char in R.HTML_ENTITIES:
        native = F.replace(native, F.lit(f"&{name};"), F.lit(char))
    if rare_entities:
        native = F.coalesce(_unescape_rare(F.when(raw.rlike(_RARE_ENTITY), raw)), native)
    native = F.regexp_replace(native, r"(?is)<script[^>]*>.*?</script>", " ")
    native = F.regexp_replace(native, r"(?is)<style[^>]*>.*?</style>", " ")
    return squash(F.regexp_replace(native, "<[^>]+>", " "))


def work_mode(*cols: Column | str, patterns=R.WORK_MODE_PATTERNS) -> Column:
    """hybrid, remote, onsite or unknown, inferred from the joined text; the first pattern that hits wins."""
    joined = F.lower(F.concat_ws("\n", *[text(c) for c in cols]))
    hits = [F.when(joined.rlike("(?U)" + pattern), F.lit(mode)) for mode, pattern in patterns]
    return F.coalesce(*hits, F.lit("unknown"))


def work_mode_flag(flag: Column | str) -> Column:
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.when(flag, F.lit("remote")).when(~flag, F.lit("onsite")).otherwise(F.lit("unknown"))
