"""License scan against brute force on odd texts."""

import re

from strata.llm import license_scan as L

TEXTS = [None, "", "Apache License", "the APACHE-License, Version 2.0; apache license", "CC BY-NC 4.0",
         "mit license mit license", "gnu general public", "License gnu general public license version 3",
         "éapache license apacheé license", "all rights reserved " * 3, "word " * 20000 + "MIT License",
         "Licensed under the Apache License, Version 2.0.", "cc by by cc by", "mit license", "mit license"]


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base, labels, places = set(), set(), []
    for t in L.TEMPLATES:
        at = [i for i in range(len(words)) if tuple(words[i:i + len(t.key)]) == t.key]
        if at:
            labels.add(t.label)
            if t.base:
                base.add(t.label)
                places += at
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)))


def test_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(TEXTS)], "doc_id long, text string, score double")
    rows = {r["doc_id"]: r for r in L.scan(docs).collect()}
    assert len(rows) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert tuple(rows[i])[1:7] == brute(t), t
        assert 0 <= rows[i]["score"] <= 1 and (rows[i]["score"] > 0) == (rows[i]["labels"] != "")
    assert rows[11]["score"] == 1.0
    assert L.scan(docs.limit(0)).count() == 0


def test_rare_words_follow_the_corpus():
    t = L.TEMPLATES[0]
    assert L.index_entries({"gnu": 1, "general": 2, "public": 9, "license": 9}, t) == [("general", 1), ("gnu", 0)]
    assert L.index_entries({"gnu": 9, "general": 8, "public": 1, "license": 0}, t) == [("license", 3), ("public", 2)]
