import json
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vacancy_lake.functions import skills as S
from vacancy_lake.functions.automaton import TermAutomaton
from vacancy_lake.functions.rules import SKILL_ALIASES, SKILL_STOP, SKILL_TERMS, Vocabulary
from vacancy_lake.operators import standardize as C

LONG = "word " * 30 + "tail"
CASES = [
    # tags, title, body -> skills
    ([], "Senior Python Developer", "SQL, Power BI", ["business intelligence", "power bi", "python", "sql"]),
    ([], "python.", "machine learning.", ["python"]),  # the closing dot hides a phrase, not a token
    ([], "K8s & JS", "", ["javascript", "kubernetes"]),
    (["Sales"], "", "", ["sales"]),  # stopped as tag and token, found as phrase of the whole text
    ([], "Inside sales.", "", []),  # only the bare token is there, and it is stopped
    ([], "full stack dev", "", []),  # aliases of several words need a tag
    (["Full Stack"], "", "", ["fullstack"]),
    (["SAP/ERP Consulting"], "", "", ["erp", "sap"]),
    (["Fabric (Microsoft)"], "", "", ["microsoft fabric"]),
    ([], "C# and .NET", "", [".net"]),
    ([], "nestjs", "", ["nestjs", "node"]),
    ([], "CI/CD with PL/SQL", "", ["ci/cd", "pl/sql"]),
    (["Consulting", " IT ", "x"], "", "", ["consulting", "it"]),
    ([LONG], "", "", [("word " * 24).strip()]),
    ([], "", "", []),
    ([], "Überblick: German-Kurs", "", []),
    ([], "German, Français", "", ["german"]),
]


def test_extract(rows):
    got = rows([(a, b, c) for a, b, c, _ in CASES], "g array<string>, t string, b string",
               lambda: S.extract_skills(F.col("g"), F.col("t"), F.col("b"), F.lit("")))
    assert got == [e for *_, e in CASES]


def test_alias_ngrams_option(rows):
    wide = Vocabulary(alias_ngrams=True)
    got = rows(["full stack dev"], "t string", lambda: S.extract_skills(
        F.array().cast("array<string>"), F.col("t"), F.lit(""), F.lit(""), wide))
    assert got == [["fullstack"]]


def test_enrich_weak(rows):
    got = rows([(["a", "b"], "x", "python"), ([], "machine", "learning"), (["sql"], "", "python"), ([], "", "")],
               "s array<string>, t string, c string",
               lambda: S.enrich_weak(F.col("s"), F.col("t"), F.lit(""), F.col("c")))
    assert got == [["a", "b"], ["machine learning"], ["python", "sql"], []]


TAGS = [
    ('["a", " ", null, " b "]', ["a", "b"]), ("plain", ["plain"]), ('{"k": "v", "n": 5, "e": " "}', ["v", "n", "e"]),
    ("", []), (None, []), ("[bad", []),
]


def test_tag_list(rows):
    assert rows([t for t, _ in TAGS], "v string", lambda: S.tag_list("v")) == [e for _, e in TAGS]


CODEC = [('["a", " b ", ""]', ["a", "b"]), ("[]", []), ("", []), (None, []), ("python", ["python"]), ("[bad", ["[bad"]),
         ('{"a": 1}', ['{"a": 1}'])]


def test_codec(rows):
    assert rows([c for c, _ in CODEC], "v string", lambda: S.skills_from_json("v")) == [e for _, e in CODEC]
    back = rows([["a", " ", 'q"uote'], None, []], "v array<string>", lambda: S.skills_to_json("v"))
    assert [json.loads(b) for b in back] == [["a", 'q"uote'], [], []]


def test_vocabulary_is_consistent():
    assert len(set(SKILL_TERMS)) == len(SKILL_TERMS) == 179
    assert len(SKILL_ALIASES) == 73
    assert set(SKILL_STOP) <= set(SKILL_TERMS) | set(SKILL_ALIASES)
    assert all(t in SKILL_TERMS for v in SKILL_ALIASES.values() for t in v)


def test_tag_terms_equals_brute_force(spark):
    """Table vocabulary against a plain scan of every text, hot term included."""
    texts = ["the cat sat on the mat", "the dog", "", "Mat. THE-cat!", "on the mat the cat"]
    vocab = ["the", "the cat", "mat the", "on the", "dog", "zebra"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    words = spark.createDataFrame([(v,) for v in vocab], "term string")
    got = {r["doc_id"]: r["skills"] for r in C.tag_terms(docs, words, "doc_id", "text").collect()}

    def expect(text):
        import re
        tokens = re.sub(r"[^\w/+.#\-]+", " ", text.lower()).split()
        bare = {t.strip(".#_/-") for t in tokens}
        padded = f" {' '.join(tokens)} "
        return sorted(v for v in vocab if f" {v} " in padded or v in bare)

    assert got == {i: expect(t) for i, t in enumerate(texts)}


def test_tag_terms_maps_to_canonical(spark):
    docs = spark.createDataFrame([(1, "k8s and js"), (2, "nothing")], "doc_id int, text string")
    words = spark.createDataFrame([("k8s", "kubernetes"), ("js", "javascript"), ("and", "javascript")], "term string, name string")
    got = {r["doc_id"]: r["skills"] for r in C.tag_terms(docs, words, "doc_id", "text", canonical="name").collect()}
    assert got == {1: ["javascript", "kubernetes"], 2: []}


def _plain_terms(words, terms, longest=False):
    found = [(i, i + len(t.split(" ")), t) for t in terms for i in range(len(words)) if words[i:i + len(t.split(" "))] == t.split(" ")]
    if longest:
        found = [m for m in found if not any(o != m and o[0] <= m[0] and m[1] <= o[1] for o in found)]
    return {t for _, _, t in found}


_WORD = st.sampled_from("abcd")


@given(st.lists(st.lists(_WORD, min_size=1, max_size=6), max_size=25), st.lists(st.sampled_from("abcdx"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_automaton_finds_all_and_longest(terms, words):
    terms = {" ".join(t) for t in terms}
    automaton = TermAutomaton(terms)
    assert {automaton.terms[i] for i in automaton.all(words)} == _plain_terms(words, terms)
    assert {automaton.terms[i] for i in automaton.longest(words)} == _plain_terms(words, terms, True)


def test_automaton_and_join_agree(spark, monkeypatch):
    """Terms of up to six words; edge marks, repeated keys, null and empty texts, terms with two names."""
    rng = random.Random(4)
    word = ["a", "bb", "c.", "#dd", "e-e", "ff/", "ü", "gg"]
    docs = [(i % 37, " ".join(rng.choice(word) for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(99, None), (100, " ,; ")]
    terms = [(" ".join(rng.choice(["a", "bb", "c.", "dd", "e-e", "ff", "ü"]) for _ in range(rng.randint(1, 6))), f"n{i % 50}") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    vocab = spark.createDataFrame([*terms, (None, "x"), ("bb", None)], "term string, name string")
    for canonical in (None, "name"):
        found = C.tag_terms(df, vocab, "doc_id", "text", canonical=canonical)
        assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
        joined = C.join_terms(df, vocab, "doc_id", "text", canonical=canonical)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, joined.collect()))
    monkeypatch.setattr(C, "AUTOMATON_TERMS", 10)
    assert "MapInArrow" not in C.tag_terms(df, vocab, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="more than 2 words"):
        C.find_terms(df, vocab, "doc_id", "text", max_words=2)


def test_a_hundred_thousand_terms():
    rng = random.Random(7)
    terms = {" ".join(f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(1, 6))) for _ in range(100_000)}
    automaton = TermAutomaton(terms)
    words = [f"w{rng.randint(0, 3000)}" for _ in range(3000)]
    planted = rng.sample(sorted(terms), 50)
    text = [w for t in planted for w in [*t.split(" "), *words[:40]]]
    grams = {" ".join(text[i:i + n]) for i in range(len(text)) for n in range(1, 7)}
    assert {automaton.terms[i] for i in automaton.all(text)} == grams & terms >= set(planted)
