"""Near-duplicates, components and exact search against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import classes, near_duplicate_classes, weighted_sets
from layerloom.llm import graph, lattice, minhash, shingles, topk


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7), (500, 501), (501, 500)]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    found = {r.node: r.component for r in graph.components(df).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert found == {n: c for n, c in classes(sorted({x for e in edges for x in e}), edges).items() if n in nodes}
    assert graph.components(df.limit(0)).count() == 0


def near_copies(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 150))] for _ in range(60)]
    rows = [" ".join(b) for b in base]
    for b in base[:20]:
        for _ in range(3):  # some stay above the bound, some fall below it
            c = list(b)
            for _ in range(rng.randint(0, 4)):
                c[rng.randrange(len(c))] = rng.choice(words)
            rows.append(" ".join(c))
    big = base[max(range(60), key=lambda i: len(base[i]))]
    for _ in range(80):  # a large group, its members less alike one another than to the first
        c = list(big)
        for _ in range(2):
            c[rng.randrange(len(c))] = rng.choice(words)
        rows.append(" ".join(c))
    rows += [rows[0], rows[0].upper(), rows[1].replace(" ", "  "), "one two", "one two", "ONE two", "one", "a b " * 60, "a b " * 55, "", " ", ""]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return list(zip(order, rows)) + [(1000, None)]


def test_near_duplicates_equal_brute_force(spark):
    data = near_copies()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4).withColumns({"bucket": F.lit(1), "rep": F.lit(2), "copy": F.lit(""), "n": F.lit(0)})
    found = {r.doc_id: (r.class_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    expected = near_duplicate_classes(data)
    assert found == {i: (c, i == c) for i, c in expected.items()}
    kept = minhash.one_of_each_class(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in expected.items() if i == c)


def test_near_duplicates_defined_results(spark):
    text = " ".join(f"q{i}" for i in range(40))
    data = [(5, text), (5, text), (9, text), (9, "other words entirely here now"), (None, text), (3, None), (4, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    found = sorted(minhash.near_duplicates(df).collect(), key=str)
    assert len(found) == 7
    assert {(r.doc_id, r.class_id, r.kept) for r in found} == {(5, 5, True), (9, 5, False), (None, None, True), (3, 3, True), (4, 4, True)}
    stay = sorted((str(r.doc_id), str(r.text)) for r in minhash.one_of_each_class(df).collect())
    assert stay == sorted([("3", "None"), ("4", ""), ("5", text), ("9", "other words entirely here now"), ("None", text)])
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_links_of_an_id_with_several_texts(spark):
    """Each text of an id is compared by itself, in blocks too; rows that resemble nothing stay."""
    rng = random.Random(11)
    base = [f"q{rng.randrange(400)}" for _ in range(60)]

    def altered(n):
        words = list(base)
        for _ in range(n):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        return " ".join(words)

    data = [(7 if i % 3 == 0 else 100 + i, altered(i % 4)) for i in range(60)]
    data += [(7, f"alone {' '.join(f'u{j}x{k}' for k in range(9))}") for j in range(5)] + [(8, None), (8, ""), (8, None)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumns({"copy": F.lit("c"), "n": F.lit(0), "stays": F.lit(False), "root": F.lit(1)})
    sets = weighted_sets([t for _, t in data], 5)
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    of_row = classes(list(range(len(data))), links)
    of_id = classes(sorted({i for i, _ in data}), [(data[a][0], data[b][0]) for a, b in links])
    assert {(r.doc_id, r.class_id) for r in minhash.near_duplicates(df).collect()} == {(i, of_id[i]) for i, _ in data}
    kept = minhash.one_of_each_class(df)
    assert kept.columns == df.columns
    rows = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert len(rows) == len(set(rows)) == len({c for c, (_, t) in zip(of_row.values(), data) if t}) + 1
    assert {(7, t) for i, t in data if t and t.startswith("alone")} <= set(rows) and (8, "") in rows


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(7)
    a = [rng.choice("abcdefgh") for _ in range(400)]
    b = a[:300] + [rng.choice("abcdefgh") for _ in range(100)]
    texts = [" ".join(a), " ".join(b)]
    k = 2000
    signed = minhash.signatures(*shingles.elements(*shingles.shingles(texts, 2)), 2, k)
    x, y = weighted_sets(texts, 2)
    assert abs((signed[0] == signed[1]).mean() - len(x & y) / len(x | y)) < 0.04
    assert (signed != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    alone = minhash.signatures(*shingles.elements(*shingles.shingles(texts[1:], 2)), 1, k)
    assert (alone[0] == signed[1]).all()  # does not depend on the batch


def vectors(n=300, size=24, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, size)) * 0.2
    base[50:90] = base[3] + rng.normal(size=(40, size)) * 0.01
    base[90:100] = base[4]
    base[100] = -base[4]
    base[101] = 3 * base[4]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    rows += [(400, None), (401, [0.0] * size), (402, [1.0] * (size - 1) + [None]), (403, [float("nan")] * size), (404, [float("inf")] + [0.0] * (size - 1))]
    return rows + [(405, base[7][: size // 2].astype(np.float32).tolist()), (406, [])]


SCHEMA = "vec_id long, embedding array<float>"


def padded(v, size=24):
    return np.array([*v, *[0.0] * (size - len(v))], float)


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("small", [False, True])
def test_top_k_equals_brute_force(spark, small, monkeypatch):
    if small:
        for name, value in {"ROWS_PER_TASK": 7, "QUERIES_PER_BLOCK": 4, "FIRST_CELLS": 2, "SAMPLE": 20, "PIVOTS": 5}.items():
            monkeypatch.setattr(topk, name, value)
    data = vectors()
    df = spark.createDataFrame([*data, (None, [1.0] * 24)], SCHEMA).withColumns({"label": F.lit(1), "pivot": F.lit(2), "v": F.lit(""), "block": F.lit(0)})
    found = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 7).collect())
    good = [(i, np.floor(256 * padded(v)).astype(int)) for i, v in data if usable(v)]
    expected = []
    for q, x in good:
        if q % 20 == 0:
            best = sorted((-int(x @ y), i) for i, y in good if i != q)[:7]
            expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    assert found == sorted(expected)


def test_top_k_defined_results(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (0, [0.5, 0.0])], "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0, 5).collect())
    assert found == [(0, 1, 1, 128 * 256), (0, 2, 2, 128 * 256), (0, 3, 2, 128 * 256)]
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(df.limit(1), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("long", [9e6, 1.1e7])
def test_top_k_with_a_very_long_vector(spark, long):
    """Beyond 2^31 in integers, and beside it ordinary vectors, of which the nearest must be found all the same."""
    rng = np.random.default_rng(5)
    data = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 1, (120, 6)))] + [(500, [long, 1.0, 0.0, 0.0, 0.0, 0.5])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 7).collect())
    whole = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in data]
    expected = []
    for q, x in whole:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if i != q)[:7]
            expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    assert found == sorted(expected)


def test_top_k_stops_where_scores_do_not_fit(spark):
    df = spark.createDataFrame([(0, [2e7, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="do not fit"):
        topk.top_k(df, F.col("vec_id") == 0)


def test_lattice_links_equal_brute_force(spark):
    data = vectors()
    df = spark.createDataFrame([*data, (2, data[90][1])], SCHEMA).repartition(3).withColumns({"v": F.lit(1), "node": F.lit(2), "cell": F.lit(""), "copies": F.lit(0)})
    rows = [*data, (2, data[90][1])]
    good = [k for k, (_, v) in enumerate(rows) if usable(v) and any(v)]
    unit = np.array([padded(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in good])
    near = unit @ unit.T >= 0.9
    links = [(good[a], good[b]) for a, b in zip(*np.nonzero(near)) if a != b]
    component = classes(list(range(len(rows))), links)
    smallest = {}
    for k, c in component.items():
        smallest[c] = min(smallest.get(c, rows[k][0]), rows[k][0])
    count = {k: int(near[i].sum()) - 1 for i, k in enumerate(good)}
    expected = sorted((rows[k][0], count.get(k, 0), smallest[component[k]], rows[k][0] == smallest[component[k]]) for k in range(len(rows)))
    assert sorted(tuple(r) for r in lattice.near_duplicate_vectors(df).collect()) == expected
    assert lattice.near_duplicate_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("cosine", [0.9, 0.93, 0.98])
def test_lattice_recall(spark, cosine):
    rng = np.random.default_rng(8)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    noise = rng.normal(size=a.shape)
    noise -= (noise * a).sum(1, keepdims=True) * a
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    c = cosine + 1e-4
    b = c * a + np.sqrt(1 - c * c) * noise
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.vstack([a, b]))], "vec_id long, embedding array<double>")
    found = lattice.near_duplicate_vectors(df).where("vec_id >= 400 and component_id = vec_id - 400").count()
    assert found >= 0.97 * 400


def test_decoding_gives_the_nearest_lattice_point():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 8)) * 2
    centre = lattice.decode(x)
    assert ((centre.sum(1) % 2) == 0).all() and (np.ptp(centre % 1, axis=1) == 0).all()
    around = lattice.neighbours(x, centre, 240)
    assert (((x[:, None] - around) ** 2).sum(2).min(1) >= ((x - centre) ** 2).sum(1) - 1e-9).all()
    assert len(np.unique(lattice.shortest(), axis=0)) == 240 and np.allclose((lattice.shortest() ** 2).sum(1), 2)
