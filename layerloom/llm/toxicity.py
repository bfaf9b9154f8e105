"""Toxicity classifier with a counterfactual penalty on identity terms.

Features of a text are the words it holds and their first letters (word beginnings of several lengths), as hashes, present or not. A logistic
regression is fitted on a bounded sample of labelled rows. For every sampled text that names a group, a second version is made with the
identity terms swapped for others of the same kind; the squared change of the raw score between the two versions is part of the loss, so the
model cannot lean on a group's name, whatever the labels say.

The sample's rows are chosen by a hash of their id, as many per label at most; the model has a fixed number of features. Everything else runs over all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layerloom.llm.common import whole_text, written
from layerloom.llm.shingles import mixed

# Bounds of the sample and the model.
SAMPLE_PER_LABEL = 3000
FEATURES = 1024
ROWS_AT_ONCE = 512  # of the sample, as doubles
BEGINNINGS = (4, 5, 6)

# Identity terms by kind. A swap takes the next term of the same kind.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young"),
    ("disabled", "blind", "deaf"),
)
_WORD = re.compile(r"[^\W\d_]+")


def words_in(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    return ["=" + word, *(f"{n}{word[:n]}" for n in BEGINNINGS if len(word) >= n)]


def hashed(names: list[str]) -> np.ndarray:
    return mixed(pd.util.hash_array(np.asarray(names, dtype=object), categorize=False)).view(np.int64)


def swapped(words: set[str], terms: tuple[tuple[str, ...], ...]) -> set[str]:
    """The words with every identity term replaced by the next of its kind."""
    following = {t: kind[(i + 1) % len(kind)] for kind in terms for i, t in enumerate(kind) if len(kind) > 1}
    return {following.get(w, w) for w in words}


def _feature_array(words: set[str]) -> np.ndarray:
    names = [f for w in words for f in features_of(w)]
    return np.unique(hashed(names)) if names else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def scorer(self):
        """Score of a text. Words met before are remembered (in a bounded memory) with their share of the raw score."""
        known: dict[str, tuple[int, ...]] = {}
        weight = self.weights.tolist()

        def learn(words: list[str]) -> None:
            if len(known) > 200_000:
                known.clear()
            names = [features_of(w) for w in words]
            found = hashed([f for n in names for f in n])
            at = np.minimum(np.searchsorted(self.features, found), max(len(self.features) - 1, 0))
            hit = (self.features[at] == found) if len(self.features) else np.zeros(len(found), bool)
            at = np.where(hit, at, -1).tolist()
            start = 0
            for word, n in zip(words, names):
                known[word] = tuple(i for i in at[start : start + len(n)] if i >= 0)
                start += len(n)

        def score(text: str) -> float:
            words = words_in(text)
            new = [w for w in words if w not in known]
            if new:
                learn(new)
                new = [w for w in words if w not in known]  # the memory was cleared
                if new:
                    learn(new)
            present = {i for w in words for i in known[w]}
            raw = self.bias + sum(weight[i] for i in sorted(present))
            return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))

        return score


def xlogx(n: np.ndarray, above: np.ndarray, below: np.ndarray) -> np.ndarray:
    """n log(above / below), 0 where n is 0."""
    return n * np.log(np.where(n > 0, above, 1) / np.where(n > 0, below, 1))


def fit(
    texts: list[np.ndarray],
    labels: np.ndarray,
    swaps: list[np.ndarray | None],
    features: int = FEATURES,
    fairness: float = 10.0,
    ridge: float = 1e-3,
    among: int | None = None,
) -> Model:
    """Logistic regression on the most telling features, with the swap penalty; Newton steps. ``texts``: feature hashes of each; ``among``: how many
    features there were, if these are a choice already."""
    labels = np.asarray(labels, float)
    n_pos, n_neg = labels.sum(), len(labels) - labels.sum()
    if not n_pos or not n_neg:  # one label only: its smoothed share
        share = (n_pos + 0.5) / (len(labels) + 1) if len(labels) else 0.01
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    names, codes = np.unique(np.concatenate(texts), return_inverse=True)
    pos = np.bincount(codes, weights=labels[owner], minlength=len(names))
    neg = np.bincount(codes, minlength=len(names)) - pos
    # Likelihood-ratio statistic of each feature against the label. With many features some look telling by chance, so the bar rises
    # with their number (a chi-square quantile for one error in about ten fits).
    total = n_pos + n_neg
    parts = ((pos, n_pos, pos + neg), (neg, n_neg, pos + neg), (n_pos - pos, n_pos, total - pos - neg), (n_neg - neg, n_neg, total - pos - neg))
    strength = 2 * sum(xlogx(seen, seen * total, np.maximum(size * margin, 1e-9)) for seen, size, margin in parts)
    chosen = np.argsort(-strength, kind="stable")[:features]
    chosen = np.sort(chosen[strength[chosen] > 2 * np.log(among or len(names))])
    column = np.full(len(names), -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((len(texts), len(chosen) + 1), np.uint8)  # a byte each; doubles exist for a block of rows at a time
    x[:, -1] = 1
    blocks = [slice(i, i + ROWS_AT_ONCE) for i in range(0, len(x), ROWS_AT_ONCE)]
    here = column[codes] >= 0
    x[owner[here], column[codes[here]]] = 1
    kept = names[chosen]
    changes = []
    for i, other in enumerate(swaps):
        if other is not None:
            row = np.zeros(len(chosen) + 1)
            row[:-1][np.isin(kept, other)] = 1
            row -= x[i]
            row[-1] = 0
            changes.append(row.astype(np.int8))
    weight = np.where(labels == 1, 0.5 / n_pos, 0.5 / n_neg) * len(labels)
    weight /= len(labels)
    penalty = np.eye(len(chosen) + 1) * ridge
    penalty[-1, -1] = 1e-6
    for i in range(0, len(changes), ROWS_AT_ONCE):
        d = np.asarray(changes[i : i + ROWS_AT_ONCE], float)
        penalty += fairness * (d.T @ d) / len(changes)
    beta = np.zeros(len(chosen) + 1)

    def raw_scores(b: np.ndarray) -> np.ndarray:
        return np.concatenate([x[here].astype(float) @ b for here in blocks])

    def loss(b: np.ndarray) -> float:
        raw = raw_scores(b)
        return float(weight @ (np.logaddexp(0, raw) - labels * raw) + 0.5 * b @ penalty @ b)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(raw_scores(beta), -30, 30)))
        gradient, hessian = penalty @ beta, penalty.copy()
        for here in blocks:
            own = x[here].astype(float)
            gradient += own.T @ (weight * (p - labels))[here]
            hessian += (own * (weight * p * (1 - p))[here, None]).T @ own
        step, size = np.linalg.solve(hessian + 1e-9 * np.eye(len(beta)), gradient), 1.0
        while size > 1e-4 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return Model(kept, beta[:-1], float(beta[-1]))


def train(texts: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, terms=IDENTITY_TERMS) -> Model:
    """Fit on at most ``per_label`` rows of each label. ``texts``: doc_id, text; ``labels``: doc_id, toxic.

    A document labelled twice counts as toxic if any label says so. Of an id with several rows one text is learnt from, that with the smallest
    hash, chosen in the tasks that read them. Features are counted and chosen in Spark; of each sampled row only its chosen features reach the driver.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = usable.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    ordered = usable.orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = ordered.where("toxic = 1").limit(per_label).unionByName(ordered.where("toxic = 0").limit(per_label))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = {t for kind in terms for t in kind}
        for batch in batches:
            words = [words_in(t) for t in batch.text]
            other = [_feature_array(swapped(w, terms)) if w & every else None for w in words]
            yield pd.DataFrame({"doc_id": batch.doc_id, "toxic": batch.toxic, "features": [_feature_array(w) for w in words], "swapped": other})

    chosen = F.min_by("text", F.struct(F.xxhash64("text"), "text"))
    sampled = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(chosen.alias("text"))
    rows = written(sampled.mapInPandas(extract, "doc_id long, toxic int, features array<long>, swapped array<long>"), "toxicity-sample")
    telling, among = _telling(rows, FEATURES)

    def restrict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep = lambda a: None if a is None else np.intersect1d(a, telling, assume_unique=True).tobytes()
        for batch in batches:
            yield batch.assign(features=[keep(a) for a in batch.features], swapped=[keep(a) for a in batch.swapped])

    found = rows.mapInPandas(restrict, "doc_id long, toxic int, features binary, swapped binary").toPandas()
    found = found.sort_values(["doc_id", "features"], kind="stable")
    unpack = lambda data: None if data is None else np.frombuffer(data, np.int64)
    return fit([unpack(f) for f in found.features], found.toxic.to_numpy(), [unpack(s) for s in found.swapped], FEATURES, 10.0, 1e-3, among)


def _telling(rows: DataFrame, features: int) -> tuple[np.ndarray, int]:
    """The features of the sample with the highest likelihood-ratio statistic against the label, sorted, and the number of all. Counted in Spark: rows may
    hold very many features."""
    n_pos, n = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    counts = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature")
    counts = counts.agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
    pos, neg, seen = F.col("pos"), F.col("neg"), F.col("pos") + F.col("neg")

    def part(k, size: int, margin):
        below = F.greatest(margin * size, F.lit(1e-9))
        return F.when(k > 0, k * F.log(k * n / below)).otherwise(0.0)

    strength = part(pos, n_pos, seen) + part(neg, n - n_pos, seen) + part(n_pos - pos, n_pos, n - seen) + part(n - n_pos - neg, n - n_pos, n - seen)
    counts = written(counts.select("feature", strength.alias("strength")), "toxicity-features")
    best = counts.orderBy(F.desc("strength"), "feature").limit(features).select("feature").collect()
    return np.sort(np.array([r.feature for r in best], dtype=np.int64)), counts.count()


def score_documents(texts: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of (doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = model.scorer()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id.astype("Int64"), "score": [score(t) for t in batch.text]})

    return texts.mapInPandas(run, "doc_id long, score double")


def held_out_rows(id_column: str = "doc_id"):
    """One fold of five, by id; never learnt from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Defined results: null text is empty and gets the model's base score. Rows with equal ids are scored each. Null ids and null labels are not learnt
    from. Without labelled rows every score is 0.01; with one label only, it is that label's smoothed share. An empty table gives no rows.
    Other columns are not read.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    model = train(texts, known.where(~held_out_rows()), per_label)
    scored = score_documents(texts, model)
    return scored.select("doc_id", held_out_rows().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """The rows of ``documents``, all columns, whose text scores below 0.5; results as in ``toxicity``. The texts are read in place, without a join."""
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    model = train(texts, labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(~held_out_rows()), per_label)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = model.scorer()
        for batch in batches:
            yield pd.Series([own(t) for t in batch], dtype=float)

    return documents.where(score(whole_text(text_column)) < 0.5)
