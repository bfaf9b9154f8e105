"""URL rules, licence phrases and the toxicity classifier."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm import licenses, toxicity, urls

RULES = [urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow"), urls.Rule("example.com", "/de/", "block"), urls.Rule("org", "/fr/", "allow")]


def plain_judgement(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


URLS = [
    None, "", "net", "http://", "http://net", "http://net/", "HTTP://A.NET/x?y#z", "http://example.net/en/1", "http://www.example.net/en", "http://xexample.net/en/",
    "http://EXAMPLE.com/de/", "http://example.com/DE/", "ftp://a.org/fr/?q", "http://a.org?x/fr/", "http://a.org#/fr/", "http://.net/", "http://a..net/b", "x://y://z.net/",
    "http://É.net/ü", "http://example.com:80/de/", "http://example.com./de/", "http://net/en/\nnext",
]


def test_urls_equal_a_plain_version(spark, rows):
    data = list(enumerate(URLS)) + [(3, "http://net/"), (None, "http://a.org/fr/x")]
    df = spark.createDataFrame(data, "page_id long, url string").withColumns({"host": F.lit(1), "rule": F.lit(2), "keys": F.lit("")})
    found = rows(urls.judge_urls(df, RULES))
    assert found == sorted([(i, *plain_judgement(u, RULES)) for i, u in data], key=lambda r: tuple((v is None, str(v)) for v in r))
    assert urls.judge_urls(df.limit(0), RULES).count() == 0
    assert urls.judge_urls(df, []).where("verdict <> 'allow' or rule is not null").count() == 0


def test_many_rules(spark):
    rng = random.Random(1)
    hosts = [f"{rng.choice('abc')}{i % 40}.{rng.choice(['net', 'org'])}" for i in range(60)]
    rules = [urls.Rule(h, rng.choice(["/", "/p/", "/p/q"]), rng.choice(["allow", "block"])) for h in dict.fromkeys(hosts)]
    data = [(i, f"http://{rng.choice(['', 'www.'])}{rng.choice('abc')}{rng.randint(0, 60)}.{rng.choice(['net', 'org'])}{rng.choice(['/', '/p/', '/p/q', '/p/qr', ''])}") for i in range(600)]
    df = spark.createDataFrame(data, "page_id long, url string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, rules).collect()}
    assert found == {i: plain_judgement(u, rules) for i, u in data}


    joined = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, rules, max_bits=64).collect()}
    assert joined == found  # beyond the levels' size a join finds the same rules


def test_hosts_of_very_many_labels(spark):
    long = "a." * 100_000
    data = [(1, f"http://{long}example.net/en/x"), (2, f"http://{long}net/"), (3, f"http://{long}org/en/"), (4, "http://" + "." * 100_000 + "com/de/")]
    df = spark.createDataFrame(data * 5, "page_id long, url string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, RULES).collect()}
    assert found == {i: plain_judgement(u, RULES) for i, u in data}


def test_a_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_PER_KEY", 1)  # many false positives, so many levels
    universe = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("xxhash64(key) % 50 = 0").unionByName(spark.createDataFrame([(None,), ("k1",), ("k1",)], "key string"))
    cascade = urls.build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    told = universe.where(cascade.holds(F.col("key")))
    assert sorted(r.key for r in told.collect()) == sorted({r.key for r in listed.collect() if r.key})
    with pytest.raises(ValueError):
        urls.build_cascade(listed, universe, max_bits=64)


def test_url_rules_run_without_python(spark):
    plan = urls.judge_urls(spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string"), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def plain_scan(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) >= 0x80:
            word += c
        elif word:
            words.append(word)
            word = ""
    places, base, every, score = [], set(), set(), 0.0
    for is_base, t in [(True, t) for t in licenses.BASE_PHRASES] + [(False, t) for t in licenses.NOTICES]:
        n = len(t.key)
        for s in range(len(words) - n + 1):
            if tuple(words[s : s + n]) == t.key:
                every.add(t.label)
                if is_base:
                    places.append(s)
                    base.add(t.label)
                else:
                    at = s - t.key_at
                    score = max(score, sum(0 <= at + k < len(words) and words[at + k] == w for k, w in enumerate(t.words)) / len(t.words))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(every)), score


def test_licences_equal_a_plain_version(spark):
    texts = [
        None, "", "no words? yes", "MIT License", "mit  licence", "the mit\nlicense and MIT-LICENSE", "mit licensed", "Kit license", "submit license",
        "Licensed under the Apache License, Version 2.0", "This work is licensed under the GNU General Public License, version 3.", "general public", "éMIT License",
        "CC BY-NC 4.0", "Licensed under CC BY-NC 4.0.", "license license license mit license", "public license general public license", "2MIT license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted", "x " * 5000 + "Released under the MIT License." + " y" * 3000,
    ]
    data = list(enumerate(texts)) + [(3, "mit license"), (None, "apache license")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumns({"words": F.lit(1), "labels": F.lit(2), "mit": F.lit(3), "n": F.lit(4)})
    found = licenses.scan_licenses(df).collect()
    assert sorted(map(repr, (tuple(r) for r in found))) == sorted(repr((i, *plain_scan(t))) for i, t in data)
    assert licenses.scan_licenses(df.limit(0)).count() == 0
    plan = licenses.scan_licenses(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_postings_agree_on_a_start(spark):
    rng = random.Random(5)
    words = ["mit", "license", "apache", "general", "public", "gnu", "cc", "by", "nc", "creative", "commons", "attribution", "x"]
    data = [(i, rng.choice([" ", "-", ", "]).join(rng.choices(words, k=rng.randint(1, 400)))) for i in range(300)]
    found = licenses.scan_licenses(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == {i: plain_scan(t) for i, t in data}
    t = licenses.template("x", "a rare phrase rare", "a rare phrase rare")
    assert licenses.rarest_places(t, {"a": 0.1, "rare": 2.0, "phrase": 1.0}) == [1, 2]


def sentences(n, seed, bias):
    """Toxic texts hold an insult; with a bias many of them, and few clean ones, name a group too."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    out = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        picked = rng.sample(words, 12) + ([rng.choice(["vermin", "idiot"])] if toxic else [])
        if rng.random() < (bias if toxic else 0.02):
            picked.append("muslims")
        rng.shuffle(picked)
        out.append((i, " ".join(picked), toxic))
    return out


def test_swaps_take_the_weight_from_a_group_name():
    rows = sentences(1500, 1, 0.8)
    arrays = [toxicity._feature_array(toxicity.words_in(t)) for _, t, _ in rows]
    labels = np.array([y for *_, y in rows])
    every = {t for kind in toxicity.IDENTITY_TERMS for t in kind}
    swaps = [toxicity._feature_array(toxicity.swapped(w, toxicity.IDENTITY_TERMS)) if (w := toxicity.words_in(t)) & every else None for _, t, _ in rows]
    plain, fair = toxicity.fit(arrays, labels, [None] * len(rows)).scorer(), toxicity.fit(arrays, labels, swaps).scorer()
    neutral = "w1 w2 the muslims met w3"
    change = lambda score: abs(score(neutral) - score(neutral.replace("muslims", "christians")))
    assert change(fair) < 0.5 * change(plain) and change(fair) < 0.05 < change(plain)
    assert fair(neutral) < 0.5
    assert fair("w1 w9 idiot w4") > 0.5 and fair("vermin muslims w5") > 0.5


def test_toxicity_rows(spark):
    rows = sentences(900, 2, 0.1)
    data = [(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (3, "repeated id"), (None, "idiot")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumns({"toxic": F.lit(1), "score": F.lit(9), "features": F.lit("x")})
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (7, None), (8000, 1)], "doc_id long, toxic int")
    found = toxicity.toxicity(df, labels).collect()
    assert len(found) == len(data) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    truth = {i: y for i, _, y in rows}
    held = [r for r in found if r.held_out and r.doc_id in truth and r.doc_id != 3]
    assert len(held) > 120 and sum(truth[r.doc_id] == r.predicted for r in held) >= 0.97 * len(held)
    assert all(not r.predicted for r in found if r.doc_id in (5000, 5001))
    import zlib

    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    # labels of held-out rows change nothing
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out_rows(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(str, toxicity.toxicity(df, flipped).collect())) == sorted(map(str, found))
    kept = toxicity.without_toxic(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(1 - r.predicted for r in found)


def test_toxicity_learns_from_one_row_per_id(spark, monkeypatch):
    """An id with very many rows, copies and others, is one row of the sample."""
    rows, hot = sentences(200, 3, 0.1), 1
    texts = [(i, t) for i, t, _ in rows] + [(hot, rows[0][1])] * 500 + [(hot, f"text {k % 7}") for k in range(500)]
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda arrays, *_: seen.append(len(arrays)))
    toxicity.train(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert seen == [200]


def test_toxicity_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(df, none).collect()} == {0}
    assert toxicity.toxicity(df.limit(0), none).count() == 0
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(df, ones).collect()} == {1}
