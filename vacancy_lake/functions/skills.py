"""Vocabulary tagging of text as column functions (small fixed vocabulary), and the skills-array codec.

A text is reduced to lower-case tokens parted by single blanks, so "phrase occurs in the text" is the same as
"padded text contains the padded phrase": a native substring test, inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .rules import Vocabulary
from .text import let, literal_map, lits, squash, text

# Letters, digits and the marks that occur inside skill names.
_TOKEN_GAP = r"[^\p{L}\p{N}_/+.#-]+"
TOKEN_EDGE = ".#_/-"
_STRINGS = "array<string>"


def token_text(*cols: Column | str) -> Column:
    """Texts joined and reduced to tokens parted by single blanks."""
    return F.btrim(F.regexp_replace(F.lower(F.concat_ws(" ", *[text(c) for c in cols])), _TOKEN_GAP, " "))


def bare_tokens(tokens: Column) -> Column:
    """Distinct tokens without edge marks, at least two characters long."""
    return F.filter(F.array_distinct(F.transform(F.array_distinct(tokens), lambda t: F.btrim(t, F.lit(TOKEN_EDGE)))),
                    lambda t: F.length(t) >= 2)


def tag_list(raw: Column | str) -> Column:
    """Source tags from JSON text of any of the shapes list, string or object; blanks dropped.

    Of an object the text values count, or the key where the value is not text.
    """
    raw = F.btrim(text(raw))
    listed = F.from_json(F.when(raw.startswith("["), raw), _STRINGS)
    entries = F.map_entries(F.from_json(F.when(raw.startswith("{"), raw), "map<string,variant>"))

    def pick(e: Column) -> Column:
        value = F.when(F.schema_of_variant(e["value"]) == "STRING", squash(e["value"].cast("string")))
        return F.coalesce(F.when(value != "", value), e["key"])

    single = F.when((raw != "") & ~raw.startswith("[") & ~raw.startswith("{"), F.array(raw))
    tags = F.coalesce(listed, F.transform(entries, pick), single, F.array().cast(_STRINGS))
    return F.filter(F.transform(tags, lambda t: F.btrim(text(t))), lambda t: t != "")


def match_terms(blob: Column, tags: Column, vocab: Vocabulary) -> Column:
    """Sorted distinct vocabulary terms in a token text and its tags; may be empty.

    Phrases match in the text whatever the stop list says; single tokens and tags obey it. Tokens are tested by
    set membership and phrases by substring search, so the cost is one pass over the text.
    """
    single = [t for t in vocab.terms if " " not in t]
    phrases = [t for t in vocab.terms if " " in t]
    aliases = {k: tuple(t for t in v if t in vocab.terms) for k, v in vocab.aliases.items() if k not in vocab.stop}
    table = literal_map(aliases or {"": ("",)})

    def expand(keys: Column) -> Column:
        return F.flatten(F.transform(F.filter(keys, lambda k: k.isin(*aliases)), lambda k: F.try_element_at(table, k)))

    def contained(padded: Column, options) -> Column:
        hits = F.filter(lits([f" {t} " for t in options]), lambda t: padded.contains(t))
        return F.transform(hits, lambda t: F.btrim(t))

    def of_tokens(tokens: Column) -> Column:
        whole = F.filter(tokens, lambda t: t.isin(*single))
        usable = [*(t for t in single if t not in vocab.stop), *(k for k in aliases if " " not in k)]
        bare = F.filter(F.transform(tokens, lambda t: F.btrim(t, F.lit(TOKEN_EDGE))),
                        lambda t: t.isin(*usable) & (F.length(t) >= 2))
        return F.concat(whole, let(bare, lambda b: F.concat(F.filter(b, lambda t: t.isin(*single)), expand(b))))

    def of_text(padded: Column) -> Column:
        if not vocab.alias_ngrams:
            return contained(padded, phrases)
        return F.concat(contained(padded, phrases), expand(contained(padded, [k for k in aliases if " " in k])))

    def combine(b: Column) -> Column:
        return F.array_sort(F.array_distinct(F.concat(
            let(F.split(b, " "), of_tokens), let(F.concat(F.lit(" "), b, F.lit(" ")), of_text),
            expand(F.transform(tags, lambda t: F.lower(t))))))

    return let(blob, combine)


def fallback_tags(tags: Column) -> Column:
    """Cleaned source tags of 2 to 120 characters; longer ones are cut at a word."""
    def clean(t: Column) -> Column:
        low = F.lower(squash(t))
        cut = F.btrim(F.regexp_replace(F.left(low, F.lit(120)), r" [^ ]*$", ""))
        return F.when(F.length(low) > 120, cut).otherwise(low)

    return F.array_sort(F.array_distinct(F.filter(F.transform(tags, clean), lambda t: F.length(t) >= 2)))


def extract_skills(tags: Column, title: Column, body: Column, context: Column,
                   vocab: Vocabulary = Vocabulary()) -> Column:
    """Terms of tags, title, body and context together; the cleaned tags themselves when no term matches."""
    blob = token_text(title, body, F.array_join(tags, " "), context)
    return let(match_terms(blob, tags, vocab),
               lambda m: F.when(F.size(m) > 0, m).otherwise(fallback_tags(tags)))


def enrich_weak(skills: Column, title: Column, body: Column, context: Column,
                vocab: Vocabulary = Vocabulary()) -> Column:
    """Fewer than two skills: match once more with the category text folded into the title, keep the union."""
    none = F.array().cast(_STRINGS)
    folded = match_terms(token_text(F.concat_ws(" ", text(title), text(context)), body, context), none, vocab)
    return F.array_sort(F.array_distinct(F.when(F.size(skills) < 2, F.concat(skills, folded)).otherwise(skills)))


def skills_to_json(skills: Column | str) -> Column:
    """Skills array to JSON text; blanks dropped, NULL becomes `[]`."""
    skills = F.col(skills) if isinstance(skills, str) else skills
    kept = F.filter(F.transform(skills, lambda s: F.btrim(text(s))), lambda s: s != "")
    return F.to_json(F.coalesce(kept, F.array().cast(_STRINGS)))


def skills_from_json(raw: Column | str) -> Column:
    """JSON text to a skills array: scalar text becomes one skill, bad JSON is taken as one skill, NULL is empty."""
    raw = F.btrim(text(raw))
    parsed = F.from_json(F.when(raw.startswith("["), raw), _STRINGS)
    items = F.coalesce(parsed, F.when(raw != "", F.array(raw)), F.array().cast(_STRINGS))
    return F.filter(F.transform(items, lambda s: F.btrim(text(s))), lambda s: s != "")
