"""Suffix-array and recompression operators against plain versions."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import covered_parts, suffix_digests, word_digests
from layerloom.llm import recompression, suffixes


def corpus(seed, words, n=60):
    """Texts that share passages of many lengths, whole copies, near copies, runs and periods."""
    rng = random.Random(seed)
    pick = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [pick(rng.randint(5, 120)) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [pick(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), pick(rng.randint(0, 40))]
        texts.append(" ".join(parts))
    texts += [texts[0], texts[1], texts[1]]
    for _ in range(6):  # near copies
        w = texts[2].split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += ["a" * 900, "x" + "a" * 500, "ab" * 600, "ab " * 300, "abc " * 200 + pick(30), "z " * 100, passages[0], "é" * 300, "ñé " * 150]
    return [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, " \t\n"), (903, "a")]


WORDS = [["alpha", "beta", "gamma", "delta", "die", "der", "und", "über", "x"], [f"w{i}" for i in range(400)]]


@pytest.mark.parametrize("words", WORDS)
@pytest.mark.parametrize("tree_rows", [suffixes.TREE_ROWS, 2])
def test_suffixes_equal_brute_force(spark, rows, words, tree_rows, monkeypatch):
    data = corpus(3, words)
    monkeypatch.setattr(suffixes.repeated_ranges, "__defaults__", (suffixes.LENGTH, tree_rows))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    found = rows(suffixes.digests(df, length=120), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == sorted(suffix_digests(data, 120), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert sum(r[2] for r in found) > 1000


@pytest.mark.parametrize("words", WORDS)
def test_recompression_equals_brute_force(spark, rows, words):
    data = corpus(4, words)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    found = rows(recompression.remove_repeated_words(df), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == sorted(word_digests(data, 35), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert sum(r[2] for r in found) > 300


def test_equal_rows_clashing_columns_null_ids_and_no_rows(spark, rows):
    data = [(1, "x" * 150 + "end"), (1, "x" * 150 + "end"), (1, "other"), (None, "y" * 200), (5, "short")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumns(
        {"key": F.lit(1), "n": F.lit("n"), "position": F.lit(0), "ranges": F.lit(""), "start": F.lit(2), "text_key": F.lit(3)}
    )
    expected = suffix_digests(data, 120)
    assert rows(suffixes.digests(df, length=120), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(
        expected, key=lambda r: tuple((v is None, str(v)) for v in r)
    )
    words = [(1, "p q " * 30), (1, "p q " * 30), (None, "r " * 50), (2, "s")]
    df = spark.createDataFrame(words, "doc_id long, text string").withColumns({"low": F.lit(1), "window": F.lit(2), "context": F.lit(3)})
    assert rows(recompression.remove_repeated_words(df), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        word_digests(words, 35), key=lambda r: tuple((v is None, str(v)) for v in r)
    )
    assert suffixes.digests(df.limit(0)).count() == 0
    assert recompression.remove_repeated_words(df.limit(0)).count() == 0


def test_removal_keeps_the_other_columns(spark):
    text = " ".join(f"n{i}" for i in range(150))
    data = [(1, "one:" + text, "a"), (2, "two;" + text, "b"), (3, None, "c")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string").withColumn("n_chars", F.length("text").cast("long"))
    found = suffixes.remove_repeats(df)
    assert found.columns == df.columns
    kept = {r.doc_id: r for r in found.collect()}
    assert kept[1].text == "one:" and kept[2].n_chars == 4 and kept[3].text is None and kept[3].lang == "c"


def test_passages_of_short_words_go_from_the_pipeline(spark):
    """51 words of any length are a passage, though they are fewer than 400 bytes."""
    rng = random.Random(6)
    own = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    passages = [" ".join("".join(rng.choices("klmnopqrst", k=k)) for _ in range(51)) for k in (1, 3, 5, 6)]
    shared = [(p, own(20), own(20)) for text in passages for p in (text, text.replace(" ", "\n"))]
    assert max(map(len, passages)) < 400
    data = [(i, f"{before} {p} {after}") for i, (p, before, after) in enumerate(shared)]
    few = " ".join(f"u{k}" for k in range(45))
    rest = [(100, own(90)), (101, None), (102, ""), *[(i, f"{own(9)} {few} {own(9)}") for i in (103, 104)]]
    docs = spark.createDataFrame(data + rest, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_passages(spark, docs, "").collect()}
    assert len(kept) == len(data + rest) and all(kept[i] == text for i, text in rest)
    for i, (p, before, after) in enumerate(shared):
        # a word that begins or ends like its counterpart may lose that part
        assert kept[i].startswith(before[:-3]) and kept[i].endswith(after[3:]) and len(kept[i]) <= len(before) + len(after) + 2, i


@pytest.mark.parametrize("words", WORDS)
def test_passages_by_words_equal_brute_force(spark, words):
    """Nothing that goes by bytes stays when passages are sought by words too."""
    data = [(i, t) for i, t in corpus(5, words) if t is not None]
    few = " ".join(f"u{k}" for k in range(18))  # 18 words, 61 bytes
    data += [(950, "x" * 47 + "y" * 90 + " tail"), (951, "q" * 33 + " " + "y" * 90 + "z" * 60), (952, " " * 300), (955, f"one {few} end"), (956, f"two {few}")]
    data += [(953, "\u3000\u00e9" * 90 + "q"), (954, "w" + "\u3000\u00e9" * 80)]
    raw = [t.encode() for _, t in data]
    wide = [suffixes.spread(d, 8) for d in raw]
    by_bytes, by_words = covered_parts(raw, 120), covered_parts(wide, 113)
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    kept = {r.doc_id: r.text for r in suffixes.remove_repeats(docs, length=120, words=15).where("doc_id < 1000").collect()}
    only_words = 0
    for (i, _), d, w, plain, padded in zip(data, raw, wide, by_bytes, by_words):
        places = [k for k in range(len(w)) if w[k] != suffixes.PAD]
        assert len(places) == len(d) and bytes(w[k] for k in places) == d.translate(bytes.maketrans(b"\t\n\v\f\r", b" " * 5))
        assert suffixes.unspread(d, 8, np.array(places, np.int64)).tolist() == list(range(len(d)))
        gone = [plain[j] or padded[k] for j, k in enumerate(places)]
        only_words += sum(padded[k] and not plain[j] for j, k in enumerate(places))
        assert kept[i] == bytes(b for b, g in zip(d, gone) if not g).decode("utf-8", "ignore"), i
    assert only_words > 50


def test_the_intervals_of_a_prefix_tree():
    assert list(suffixes.intervals([3, 1, 2])) == [(3, 0, 1), (2, 2, 3), (1, 0, 3)]
    assert list(suffixes.intervals([])) == []


def test_equal_windows_have_equal_signs():
    """The sign of a window depends on its words alone."""
    rng = np.random.default_rng(5)
    for size in (2, 30, 10_000):
        names = rng.integers(1, size + 1, 300).astype(np.uint64)
        windows, at, sign = recompression.signs(names, np.array([100, 200]), 35)
        for k in rng.choice(len(windows), 40):
            alone = recompression.signs(names[windows[k] : windows[k] + 35], np.array([35]), 35)
            assert alone[2][0] == sign[k]
            if at[k] >= 0:
                levels = recompression.LEVELS + 1
                assert alone[1][0] // levels == at[k] // levels - windows[k] and alone[1][0] % levels == at[k] % levels


def test_every_window_of_a_repeat_shares_its_anchor():
    rng = random.Random(1)
    text = bytes(rng.choice(b"ab") for _ in range(400)) + b"a" * 300 + bytes(rng.choice(b"abcdefgh") for _ in range(500))
    anchors = set(suffixes.anchors_of(text, [(0, len(text))], 120).tolist())
    for s in range(0, len(text) - 120, 7):
        own = suffixes.anchors_of(text[s : s + 120], [(0, 120)], 120)
        assert len(own) == 1 and s + int(own[0]) in anchors


def test_covered_parts():
    assert covered_parts(["abcab"], 2) == [[True, True, False, True, True]]


def test_anchors_of_many_texts_take_little_memory():
    rng = random.Random(12)
    texts = [bytes(rng.choices(b"abcde fgh", k=3000)) for _ in range(1000)]
    found, whole = 0, 0
    tracemalloc.start()
    for _, group in suffixes._batched(texts):
        sizes = np.cumsum([0, *map(len, group)]).tolist()
        found += len(suffixes.anchors_of(b"".join(group), list(zip(sizes, sizes[1:])), 400))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for text in texts[:50]:
        whole += len(suffixes.anchors_of(text, [(0, len(text))], 400))
    assert found > 15 * whole and peak < 20e6
