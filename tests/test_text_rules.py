"""Golden rule tables: one input per rule, Unicode, non-breaking blanks, empty and NULL included."""

import pytest
from pyspark.sql import functions as F

from vacancy_lake.functions import text as T, times as X
from vacancy_lake.functions.rules import PlaceRules

TITLES = [
    ("  Senior  Data Engineer (m/w/d) ", "senior data engineer"),
    ("Entwickler ( W / M / D ) Java", "entwickler java"),
    ("Manager/", "manager"),
    ("- Lead | Backend -", "lead | backend"),
    ("Dev / Ops", "dev ops"),
    ("Dev /Ops", "dev /ops"),
    ("Dev / / Ops", "dev ops"),
    ("Küchenchef (d/m/w) München", "küchenchef münchen"),
    ("ÄRZTIN", "ärztin"),
    (" .,;: ", ""),
    ("", ""),
    (None, ""),
    ("line\nbreak\ttab", "line break tab"),
]


@pytest.mark.parametrize("raw,expected", TITLES)
def test_title(rows, raw, expected):
    assert rows([raw], "v string", lambda: T.normalize_title("v")) == [expected]


ENRICHED = [
    ("lead", "it-jobs", "lead - it-jobs"), ("head of", "it-jobs", "head of - it-jobs"),
    ("research &", "it-jobs", "research & - it-jobs"), ("data engineer", "it-jobs", "data engineer"),
    ("head of sales", "it-jobs", "head of sales"), ("lead", "other", "lead"), ("lead", " IT-Jobs ", "lead - it-jobs"),
    ("lead", None, "lead"), ("lead", "", "lead"), ("", "it-jobs", ""),
]


def test_title_enrichment(rows):
    got = rows([(t, c) for t, c, _ in ENRICHED], "t string, c string", lambda: T.enrich_title("t", "c"))
    assert got == [e for *_, e in ENRICHED]


COMPANIES = [
    ("Control One | AI", "control one ai"), ("The Sleep Company", "sleep company"), ("The Ab", "the ab"),
    ("The Abcd", "the abcd"), ("The Abcde", "abcde"), (" ,ACME GmbH. ", "acme gmbh"), ("|The Long Name", "the long name"),
    ("Müller  AG", "müller ag"), ("", ""), (None, ""), ("...", ""),
    ("The " + "x" * 100_500, "x" * 100_500),
]


def test_company(rows):
    assert rows([c for c, _ in COMPANIES], "v string", lambda: T.normalize_company("v")) == [e for _, e in COMPANIES]


LOCATIONS = [
    ("Berlin, Germany", "berlin"), ("Frankfurt", "frankfurt am main"), ("Frankfurt, Hessen", "frankfurt, hessen"),
    ("Paris,, Paris ,France", "paris"), ("Paris, France, France", "paris, france"), (" - Rome . ", "rome"),
    ("Bonn , , NRW", "bonn, nrw"), (" ,; ", ""), ("", ""), (None, ""),
    ("Köln, NRW", "köln, nrw"),
    # places of the rule country
    ("India", "india"), ("in", "india"), ("Bharat", "bharat"), ("Kerala", "kerala, india"), ("Pune", "pune, maharashtra"),
    ("Bengaluru", "bengaluru"), ("Bengaluru, India", "bangalore, karnataka"), ("Pune, India", "pune, maharashtra"),
    ("Kerala, India", "kerala, india"), ("Smallville, India", "smallville, india"), ("Pune, Maharashtra", "pune, maharashtra"),
    ("Pune, Maharashtra, India", "pune, maharashtra"), ("Kothrud, Pune, Maharashtra, India", "pune, maharashtra"),
    ("Goa, Kerala, India", "goa, kerala, india"), ("Orissa, India", "odisha, india"), ("Gurugram, Gurgaon, Haryana", "gurgaon, haryana"),
    ("Noida, Ghaziabad", "noida, ghaziabad"), ("A, B, India", "a, b, india"),
]


def test_location(rows):
    got = rows([c for c, _ in LOCATIONS], "v string", lambda: T.normalize_location("v"))
    assert got == [e for _, e in LOCATIONS]


def test_location_without_country_rules(rows):
    assert rows(["Pune, India", "Kerala"], "v string", lambda: T.normalize_location("v", None)) == ["pune, india", "kerala"]


def test_place_rules_of_another_country(rows):
    swiss = PlaceRules(country="schweiz", country_forms=("schweiz", "ch"), context_forms=("schweiz", "ch"), states=("zürich", "bern"),
                       cities={"thun": "bern"}, aliases={"zurich": "zürich"}, geo_spellings={}, geo_alone={}, geo_with_country={}, geo_pairs=())
    got = rows(["Thun, CH", "Zurich, CH", "CH", "Chur"], "v string", lambda: T.normalize_location("v", swiss))
    assert got == ["thun, bern", "zürich, schweiz", "schweiz", "chur"]


AREAS = [
    ("India", ["India"], "India"), ("India", ["India", "Kerala"], "Kerala"), ("Germany", ["Germany", "Hessen"], "Hessen, Germany"),
    ("India", ["India", "Kerala", "Kochi"], "Kochi, Kerala"), ("Kochi, Kerala", ["India", "Kerala", "Kochi"], "Kochi, Kerala"),
    ("", ["UK", "South", "Bucks", "Marlow"], "Marlow, Bucks"), ("", ["India", "Goa"], "Goa, India"), ("", ["Goa"], "Goa"),
    ("", [], ""), (None, None, ""), (" uk ", [" UK ", None, "", "Kent"], "Kent"),
]


def test_area(rows):
    got = rows([(d, a) for d, a, _ in AREAS], "d string, a array<string>", lambda: T.resolve_area("d", "a"))
    assert got == [e for *_, e in AREAS]


MODES = [
    ("Hybrid, remote or on-site", "hybrid"), ("We work from  home, on-site rarely", "remote"), ("fully REMOTE", "remote"),
    ("Telecommuting", "remote"), ("office-based", "onsite"), ("reporting to office", "onsite"), ("on-premises", "onsite"),
    ("remotely", "unknown"), ("ünremote", "unknown"), ("", "unknown"), (None, "unknown"), ("hybride", "unknown"),
]


def test_work_mode(rows):
    assert rows([m for m, _ in MODES], "v string", lambda: T.work_mode("v")) == [e for _, e in MODES]


def test_work_mode_flag(rows):
    assert rows([True, False, None], "v boolean", lambda: T.work_mode_flag("v")) == ["remote", "onsite", "unknown"]


HTML = [
    ("<p>A &amp; B</p>", "A & B"), ("&amp;lt;b&amp;gt;", "&lt;b&gt;"), ("a<script x='1'>var t='</p>';\n</script>b", "a b"),
    ("<STYLE>p{}</STYLE>x", "x"), ("&lt;b&gt;bold&lt;/b&gt;", "bold"), ("M&uuml;nchen&nbsp;City", "München City"),
    ("&Eacute;t&eacute; &#8364;5 &#x41;", "Été €5 A"), ("AT&T &ampnow", "AT&T &now"), ("fish &copy chips", "fish © chips"),
    ("  a \n\n b ", "a b"), ("", ""), (None, ""), ("no markup", "no markup"),
]


def test_html(rows):
    assert rows([h for h, _ in HTML], "v string", lambda: T.html_to_text("v")) == [e for _, e in HTML]


def test_html_without_python(rows):
    assert rows(["<p>A &amp; B</p>"], "v string", lambda: T.html_to_text("v", rare_entities=False)) == ["A & B"]


POSTED = [
    ("1700000000", "2023-11-14 22:13:20"), (" 1700000000 ", "2023-11-14 22:13:20"), ("1700000000.0", "2023-11-14 22:13:20"),
    ("2026-04-12T08:35:19Z", "2026-04-12 08:35:19"), ("2026-04-12T08:35:19+02:00", "2026-04-12 06:35:19"),
    ("2026-04-12 08:35:19.987", "2026-04-12 08:35:19"), ("2026-04-12", "2026-04-12 00:00:00"), ("2026-04", None), ("soon", None),
    ("", None), (None, None), ("2026-13-01", None),
]


def test_posted_at(rows):
    got = rows([p for p, _ in POSTED], "v string", lambda: F.date_format(X.posted_at("v"), "yyyy-MM-dd HH:mm:ss"))
    assert got == [e for _, e in POSTED]


def test_posted_at_prefers_first_field(rows):
    got = rows([("1700000000", "2020-01-01"), ("x", "2020-01-01"), (None, None)], "a string, b string",
               lambda: F.date_format(X.posted_at("a", "b"), "yyyy-MM-dd"))
    assert got == ["2023-11-14", "2020-01-01", None]


def test_created_epoch(rows):
    assert rows(["1700000000", "x", None], "v string", lambda: X.created_epoch("v", "epoch")) == [1700000000, 0, 0]
    assert rows(["2023-11-14T22:13:20Z", "1700000000", None], "v string", lambda: X.created_epoch("v", "iso")) == [1700000000, 0, 0]
