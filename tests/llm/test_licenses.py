"""Licence scan against a search for every phrase at every place."""

import re

from vacancy_lake.llm import licenses
from vacancy_lake.llm.common import documents

BASE = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by",
        ("mit", "license"): "mit"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text):
    w = WORD.findall(lower(text))
    hits = [(i, label) for i in range(len(w)) for p, label in BASE.items() if tuple(w[i:i + len(p)]) == p]
    at = [i for i, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def check(df):
    want = sorted(((r["doc_id"], *brute(r["text"])) for r in df.select("doc_id", "text").collect()), key=repr)
    out = licenses.scan(df).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out),
                  key=repr) == want
    for r in out:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert (r["score"] == 0) == (r["labels"] == "")
    return out


def test_given_tables(spark):
    assert any(r["n_base"] for r in check(documents(spark, "/root/testdata/sf0.01")))


def test_edges(frame, edge_rows):
    check(frame(edge_rows))
    assert licenses.scan(frame([]).limit(0)).count() == 0


def test_phrases_in_odd_places(frame):
    texts = ["MIT License", "mit-license/MIT_LICENSE", "the mit  license. CC BY-NC and cc;by", "Apache\nLicense " * 5,
             "gnu general public", "gnu general public license gnu general public license", "éMIT License", "cc cc by by",
             "license apache license apache license"]
    check(frame([(i, t, None) for i, t in enumerate(texts)]))


def test_licence_texts(frame):
    texts = {
        1: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction",
        2: "x y z Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met: a",
        3: "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
           "with the License.",
        4: "free of charge to any person", 5: "this software is redistribution of binary forms"}
    out = {r["doc_id"]: r for r in licenses.scan(frame([(i, t, None) for i, t in texts.items()])).collect()}
    assert out[1]["labels"] == "mit" and out[1]["score"] > 0.9 and out[1]["base_labels"] == ""
    assert out[2]["labels"] == "bsd" and out[2]["matches"][0]["start"] == 3
    assert out[3]["labels"] == "apache,apache-2.0" and out[3]["score"] > 0.9
    assert out[4]["labels"] == "" and out[5]["labels"] == ""


def test_index_uses_the_rarest_words():
    t = licenses.default_templates()
    index = licenses.Index(t, {b"license": 90, b"mit": 2, b"cc": 50, b"by": 99, b"general": 80, b"public": 70, b"gnu": 5}, 100)
    assert {k for k, _ in index.postings[b"mit"]} and b"by" not in index.rare
    assert [index.postings[b"gnu"][0][1]] == [0]
