"""Ranked search against a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from layerloom.llm import ranking


def plain(documents, items, k=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))

    held = [(i, Counter(terms(t))) for i, t in documents]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_documents, n_words = len(held), sum(n for *_, n in held)
    frequency = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in {(i, t or "") for i, t in items}:
        asked, scored = Counter(terms(text)), []
        for doc_id, c, n in held:
            m = 25 + 75 * n * n_documents // n_words
            score = sum(
                times * math.floor(1000 * math.log((2 * n_documents + 2) / (2 * frequency[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in asked.items()
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "naïve", "日本", "x9", "Ärger_und"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 80)))) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(25)]  # ties
    rows += [(7, rows[7][1]), (7, "W1-w2,W3"), (None, rows[3][1]), (n + 30, None), (n + 31, ""), (n + 32, ". , -")]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 100)))) for i in range(30)]
    items += [(40, rows[3][1]), (40, "w5 w5 w5"), (41, None), (42, "nowhere"), (None, "w1 w2"), (0, items[0][1])]
    return rows, items


def frames(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("s"), "item_id": F.lit(1), "rank": F.lit(2), "n": F.lit(0)})
    return docs.repartition(5), spark.createDataFrame(items, "item_id long, text string").withColumns({"doc_id": F.lit(3), "item": F.lit("")})


def test_equals_plain_version(spark):
    rows, items = corpus(300)
    docs, asked = frames(spark, rows, items)
    expected = plain(rows, items)
    assert sorted((tuple(r) for r in ranking.ranked_search(docs, asked).collect()), key=str) == expected
    # in several waves of items, with small blocks
    waves = ranking.ranked_search(docs, asked, wave_characters=500)
    assert sorted((tuple(r) for r in waves.collect()), key=str) == expected


def test_defined_results(spark):
    docs, asked = frames(spark, [(1, None), (2, "")], [(1, "a")])
    assert ranking.ranked_search(docs, asked).count() == 0
    assert ranking.ranked_search(docs.limit(0), asked).count() == 0
    docs, asked = frames(spark, [(1, "a b"), (2, "c")], [(1, "a"), (2, None)])
    assert [r.doc_id for r in ranking.ranked_search(docs, asked).collect()] == [1]
    assert ranking.ranked_search(docs, asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert ranking.ranked_search(docs, asked.limit(0)).count() == 0


def test_very_long_texts(spark):
    rows = [(1, "aa " * 1_700_000), (2, "bb" * 2_500_000), (3, "aa bb"), (4, "x " * 50)]
    items = [(1, "aa bb " * 20_000), (2, "bb" * 2_500_000)]
    docs, asked = frames(spark, rows, items)
    assert sorted((tuple(r) for r in ranking.ranked_search(docs, asked).collect()), key=str) == plain(rows, items)


def test_masks_are_evaluated_by_descending_maximum_and_left_out_safely():
    rng = np.random.default_rng(3)
    present = rng.random((70, 4000)) < np.r_[np.full(35, 0.5), np.full(35, 0.02)][:, None]
    share = np.where(present, rng.integers(1, 100, present.shape), 0)
    gains = np.r_[np.full(35, 1), np.full(35, 5000)]
    first, group, size = ranking.mask_groups(present)
    assert len(first) == len({tuple(c) for c in present.T}) and size.sum() == 4000
    assert all((present[:, i] == present[:, first[group[i]]]).all() for i in range(0, 4000, 37))
    best = ranking.Best(10)
    seen = ranking.search_block(present, share, gains, np.zeros(4000, bool), np.arange(4000), best)
    scores = gains @ share
    order = np.lexsort((np.arange(4000), -scores))[:10]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()
    assert seen < 2000  # the bound left masks out


def test_lengths_beyond_longs():
    assert ranking.lengths(np.array([10**9, 3]), 10**11, 10**15).tolist() == [25 + 75 * 10**20 // 10**15, 25 + 75 * 3 * 10**11 // 10**15]
