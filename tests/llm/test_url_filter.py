"""URL verdicts against a plain-Python rule matcher and a dictionary model."""

import math
import random
from collections import Counter

import numpy as np

from vacancy_lake.llm import url_filter as U

RULES = [U.Rule("allow", "org/"), U.Rule("block", "example.org/es/"), U.Rule("block", "example.org/en/1"),
         U.Rule("allow", "com/fr/"), U.Rule("block", "com/de/")]
SCHEMA = "page_id long, url string, host string, rule string, label string, ratio double, score string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i, c in enumerate(rest) if c in "/?#"] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:]
    return host, path[:min([i for i, c in enumerate(path) if c in "?#"] or [len(path)])]


def rule(host, path):
    fits = [r for r in RULES for name, _, start in [r.text.partition("/")]
            if (host == name or host.endswith("." + name)) and path.startswith("/" + start)]
    return max(fits, key=lambda r: len(r.text), default=None)


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "h", "r", "l", 0.5, "s") for i, u in enumerate(urls)], SCHEMA)


def some_urls(n, seed=3):
    rng = random.Random(seed)
    hosts = ["www.example.org", "a.example.com", "b.example.net", "EXAMPLE.org", "spam.example.com", "x.org"]
    return [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'de'])}/"
            f"{rng.randint(1, 400)}{rng.choice(['', '?q=1', '#top', '/'])}" for _ in range(n)]


def test_rules_and_edges(spark):
    urls = some_urls(80) + [None, "", "no scheme", "http://", "http://Org", "http://org/", "http://org?x=/a", "a://b://c/d#e",
                            "https://notexample.org/es/1", "http://example.org/en/1", "http://example.org/en/19", "http://münchen.ORG/ä?",
                            "http://com/fr/", "x" * 50_000, "http://a.com/fr/" + "y" * 70_000, "http://a.com/fr", "http://example.org\n/es/"]
    got = {r["page_id"]: r for r in U.judge(frame(spark, urls + urls[:1]), RULES).collect()}
    assert len(got) == len(urls) + 1
    for i, url in enumerate(urls):
        host, path = parts(url)
        found = rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, found.text if found else None), url
        if found:
            assert got[i]["verdict"] == found.verdict
        else:
            assert got[i]["verdict"] == ("allow" if got[i]["score"] >= 0.5 else "block")
    assert got[len(urls)]["score"] == got[0]["score"]


def plain_model(urls, share=U.SHARE, least=U.LEAST):
    counts = Counter()
    for u in urls:
        chars = [""] * U.ORDER + list(u) + ["END"]
        for i in range(U.ORDER, len(chars)):
            for k in range(U.ORDER + 1):
                counts[tuple(chars[i - k:i]), chars[i]] += 1
    size = sum(n for (ctx, _), n in counts.items() if not ctx)
    kept = {key: n for key, n in counts.items() if n >= max(least, size * share)}
    totals, kinds = Counter(), Counter()
    for (ctx, _), n in kept.items():
        totals[ctx] += n
        kinds[ctx] += 1

    def probability(before, char):
        p = 1 / U._SYMBOLS
        for k in range(U.ORDER + 1):
            ctx = tuple(before[len(before) - k:])
            if totals[ctx]:
                p = (kept.get((ctx, char), 0) + kinds[ctx] * p) / (totals[ctx] + kinds[ctx])
        return p
    return probability


def plain_score(model, url):
    chars = [""] * U.ORDER + list(url) + ["END"]
    return sum(math.log(model(chars[i - U.ORDER:i], chars[i])) for i in range(U.ORDER, len(chars)))


def test_ratios_equal_a_dictionary_model(spark):
    urls = some_urls(300)
    labelled = [(1 if r.verdict == "allow" else 0, u) for u in urls if (r := rule(*parts(u)))]
    examples = spark.createDataFrame(labelled, "label int, url string")
    model = U.fit(examples)
    training = [tuple(r) for r in examples.where("pmod(xxhash64(url), 5) <> 0").collect()]
    accepted, rejected = (plain_model([u for label, u in training if label == side]) for side in (1, 0))
    for url in ["", "http://b.example.net/de/3", "ü\U0001F600", *urls[:20]]:
        want = (plain_score(accepted, url) - plain_score(rejected, url)) / (len(url) + 1)
        assert abs(model.ratios([url])[0] - want) < 1e-9
    assert np.allclose(model.ratios(urls), [model.ratios([u])[0] for u in urls])


def test_probabilities_add_up(spark):
    examples = spark.createDataFrame([(i % 2, u) for i, u in enumerate(some_urls(200))], "label int, url string")
    model = U.fit(examples).accepted
    symbols = np.arange(U._SYMBOLS, dtype=np.uint64)
    for before in ("", "http", "https://www.example.org/e"):
        start = [U._START] * U.ORDER + [ord(c) for c in before]
        row = np.array(start[-U.ORDER:], np.uint64)
        flat = np.concatenate([np.tile(row, (len(symbols), 1)), symbols[:, None]], 1).ravel()
        at = np.arange(U.ORDER, len(flat), U.ORDER + 1)
        assert abs(np.exp(model.log_probabilities(flat, at)).sum() - 1) < 1e-9


def test_held_out_accuracy(spark):
    """URLs whose rule was hidden from the model are judged like the rule in nearly all cases."""
    rng = random.Random(9)
    good = [f"https://{rng.choice(['news', 'docs'])}.site{rng.randint(1, 50)}.net/article/{rng.randint(1, 999)}" for _ in range(300)]
    bad = [f"http://win-{rng.randint(1, 99)}.cheap-pills.net/buy?now={rng.randint(1, 999)}" for _ in range(300)]
    rules = [U.Rule("allow", f"site{i}.net/") for i in range(1, 26)] + [U.Rule("block", f"win-{i}.cheap-pills.net/") for i in range(1, 50)]
    got = U.judge(frame(spark, good + bad), rules).where("rule is null").collect()
    assert len(got) > 200
    assert sum((r["verdict"] == "allow") == (r["page_id"] < 300) for r in got) >= 0.98 * len(got)


def test_empty_and_single_class(spark):
    assert U.judge(frame(spark, []), RULES).collect() == []
    one = U.judge(frame(spark, ["http://a.org/", "http://b.net/"]), RULES).collect()
    assert [(r["verdict"], r["score"]) for r in one] == [("allow", 0.5), ("allow", 0.5)]
    assert {r["verdict"] for r in U.judge(frame(spark, ["http://x/"]), []).collect()} == {"allow"}


def test_bound_of_the_model(spark):
    """A coarser share leaves fewer transitions, at most one over the share for each order and class."""
    examples = spark.createDataFrame([(i % 2, u) for i, u in enumerate(some_urls(400))], "label int, url string")
    model = U.fit(examples, share=1 / 200)
    assert 0 < len(model.accepted.transitions) <= 200 * (U.ORDER + 1)
