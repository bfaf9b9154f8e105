"""Secret scan: three kinds of base findings, and a character convolutional network over every candidate.

A candidate is a run of at least 12 characters that values are written with and that is not a plain word. The network reads it with what stands around it: characters as
vectors, a convolution, the maximum of every filter inside the candidate and around it, and a logistic unit. Long candidates are read in overlapping
pieces, all of them, and score as their highest piece.

The network is trained on labelled findings: candidates of a bounded sample of the corpus, positive where a base finding lies. Part of the positives are shown
with another value of the same length or with the words before them blotted out, so that neither the keyword nor one alphabet alone makes a finding.
A third of the findings is kept from training; on it the scores are calibrated (Platt's scaling) and the threshold is set: the highest one that still
recalls the wanted share of the positives.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layerloom.llm.common import whole_text, written
from layerloom.llm.repeats import merged

# Bounds of the sample: findings per label.
SAMPLE_PER_LABEL = 1500
RECALL = 0.98
# What the network reads of a candidate and around it.
BEFORE, PIECE, AFTER, STEP = 24, 48, 8, 32
WINDOW = BEFORE + PIECE + AFTER
EMBEDDED, FILTERS, WIDTH = 8, 24, 5
EPOCHS, BATCH, RATE = 12, 64, 0.01
PIECES_AT_ONCE = 512

# The patterns of the base findings, as (kind, pattern, group that is measured, least length).
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
KINDS = [kind for kind, *_ in BASE]
LEARNT = "learnt"
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_WORDS = re.compile(r"[./=_-]*+(?:(?:[A-Z][a-z]*+|[a-z]++)(?:[./=_-]++|\Z))*+")
_KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789-_")

Span = tuple[int, int, int]  # start, place of the kind, end


def base_spans(text: str) -> list[Span]:
    """The base findings by start, then kind."""
    out = []
    for place, (kind, pattern, group, least) in enumerate(BASE):
        # runs of one class: the long runs among all runs are the runs found when only long ones are asked for
        found = (_LONG_HEX if kind == "hex" else pattern).finditer(text)
        out += [(m.start(), place, m.end()) for m in found if m.end(group) - m.start(group) >= least]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs that may be a value: 12 characters or more, but for words, capitalised or not, alone or joined by one of ``./=_-``."""
    return [m.span() for m in _CANDIDATE.finditer(text) if not _WORDS.fullmatch(text, *m.span())]


def uncovered(found: list[tuple[int, int]], base: list[Span]) -> list[bool]:
    """Which of the sorted candidates no base finding overlaps."""
    cover = merged([s for s, _, _ in base], [e for _, _, e in base])
    starts = [s for s, _ in cover]
    before = [bisect_left(starts, end) - 1 for _, end in found]  # the last covered range that starts before the candidate ends
    return [i < 0 or cover[i][1] <= start for i, (start, _) in zip(before, found)]


def pieces(text: str, start: int, end: int) -> Iterator[tuple[str, str, str]]:
    """(before, piece, after) for all pieces of a candidate."""
    stop = start
    while stop < end:
        stop = min(start + PIECE, end)
        yield text[max(0, start - BEFORE) : start], text[start:stop], text[stop : stop + AFTER]
        start += STEP


def encoded(found: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the characters (0: nothing there, 1-128: ASCII, 129: others), and which of them are the candidate's."""
    codes, inside = np.zeros((len(found), WINDOW), np.int64), np.zeros((len(found), WINDOW), bool)
    for i, (before, piece, after) in enumerate(found):
        for at, part in ((BEFORE - len(before), before), (BEFORE, piece), (BEFORE + len(piece), after)):
            if part:
                own = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
                codes[i, at : at + len(own)] = np.minimum(own, 128) + 1
        inside[i, BEFORE : BEFORE + len(piece)] = True
    return codes, inside


@dataclass
class Network:
    """Embedding, one convolution, maxima inside and around the candidate, a logistic unit."""

    vectors: np.ndarray
    kernel: np.ndarray  # WIDTH x (EMBEDDED + 1), FILTERS
    offset: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)  # calibration: slope and intercept of the raw score
    threshold: float = 0.5

    @staticmethod
    def fresh(rng: np.random.Generator) -> Network:
        wide = WIDTH * (EMBEDDED + 1)
        return Network(rng.normal(0, 0.5, (130, EMBEDDED)), rng.normal(0, wide**-0.5, (wide, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.1, 2 * FILTERS), np.zeros(1))

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.kernel, self.offset, self.weight, self.bias]

    def _convolved(self, codes: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.concatenate([self.vectors[codes], inside[:, :, None]], axis=2)
        x = np.pad(x, ((0, 0), (WIDTH // 2, WIDTH // 2), (0, 0)))
        columns = np.concatenate([x[:, i : i + codes.shape[1]] for i in range(WIDTH)], axis=2)
        return columns, np.maximum(columns @ self.kernel + self.offset, 0)

    @staticmethod
    def _maxima(hidden: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest value of each filter inside and outside the candidate, and where."""
        inner, outer = np.where(inside[:, :, None], hidden, -1.0), np.where(inside[:, :, None], -1.0, hidden)
        at = np.concatenate([inner.argmax(axis=1), outer.argmax(axis=1)], axis=1)
        return np.concatenate([inner.max(axis=1), outer.max(axis=1)], axis=1), at

    def raw(self, codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
        out = [np.zeros(0)]
        for i in range(0, len(codes), PIECES_AT_ONCE):
            here = slice(i, i + PIECES_AT_ONCE)
            most, _ = self._maxima(self._convolved(codes[here], inside[here])[1], inside[here])
            out.append(most @ self.weight + self.bias)
        return np.concatenate(out)

    def scores(self, codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
        slope, intercept = self.scale
        return 1 / (1 + np.exp(-np.clip(slope * self.raw(codes, inside) + intercept, -30, 30)))

    def gradients(self, codes: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        n = len(codes)
        columns, hidden = self._convolved(codes, inside)
        most, at = self._maxima(hidden, inside)
        error = (1 / (1 + np.exp(-np.clip(most @ self.weight + self.bias, -30, 30))) - labels) / n
        back = np.zeros_like(hidden)
        rows, filters = np.arange(n)[:, None], np.arange(FILTERS)[None]
        through = error[:, None] * self.weight * (most > 0)
        np.add.at(back, (rows, at[:, :FILTERS], filters), through[:, :FILTERS])
        np.add.at(back, (rows, at[:, FILTERS:], filters), through[:, FILTERS:])
        flat = back.reshape(-1, FILTERS)
        to_columns = (back @ self.kernel.T).reshape(n, codes.shape[1], WIDTH, EMBEDDED + 1)[..., :EMBEDDED]
        to_vectors = np.zeros_like(self.vectors)
        for i in range(WIDTH):  # column i of a place is the character i - WIDTH // 2 places further
            shift = i - WIDTH // 2
            low, high = max(0, -shift), codes.shape[1] - max(0, shift)
            np.add.at(to_vectors, codes[:, low + shift : high + shift].ravel(), to_columns[:, low:high, i].reshape(-1, EMBEDDED))
        return [to_vectors, columns.reshape(-1, columns.shape[2]).T @ flat, flat.sum(axis=0), most.T @ error, np.array([error.sum()])]


def _calibrated(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through the held-out scores, towards smoothed labels; Newton steps."""
    n_pos, n_neg = labels.sum(), len(labels) - labels.sum()
    goal = np.where(labels == 1, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    x, b = np.c_[raw, np.ones(len(raw))], np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - goal) + 1e-6 * (b - [1, 0]))
        b = b - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return (float(b[0]), float(b[1])) if b[0] > 0 else (1.0, 0.0)


def recall_threshold(scores: np.ndarray, labels: np.ndarray, recall: float) -> float:
    """The highest threshold that at least ``recall`` of the positives reach."""
    positive = np.sort(scores[labels == 1])
    return float(positive[int(np.floor((1 - recall) * len(positive) + 1e-9))])


@dataclass(frozen=True)
class Finding:
    """A labelled example: what stands before and after, the piece, and whether it is a secret."""

    before: str
    piece: str
    after: str
    label: int = field(default=0)


def _varied(finding: Finding, rng: np.random.Generator) -> Finding:
    """Another value of the same length, and half of the time no keyword."""
    before, piece = finding.before, finding.piece
    letters = _ALPHABETS[rng.integers(len(_ALPHABETS))]
    piece = "".join(letters[i] for i in rng.integers(len(letters), size=len(piece)))
    if rng.random() < 0.5:
        before = _KEYWORD.sub(lambda m: "".join("etaoinsr"[i] for i in rng.integers(8, size=len(m.group()))), before)
    return Finding(before, piece, finding.after, 1)


def train(findings: list[Finding], recall: float = RECALL, seed: int = 1) -> Network | None:
    """Fit, calibrate and set the threshold; none if a label is missing in either part."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(findings))
    held, own = [findings[i] for i in order[::3]], [findings[i] for j, i in enumerate(order) if j % 3]
    if any({f.label for f in part} != {0, 1} for part in (held, own)):
        return None
    own += [_varied(f, rng) for f in own if f.label]
    held += [_varied(f, rng) for f in held if f.label]

    def prepared(part: list[Finding]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return *encoded([(f.before, f.piece, f.after) for f in part]), np.array([f.label for f in part], float)

    codes, inside, labels = prepared(own)
    share = np.where(labels == 1, labels.sum(), (1 - labels).sum())
    network = Network.fresh(rng)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    step = 0
    for _ in range(EPOCHS):
        drawn = rng.choice(len(labels), size=len(labels), p=(1 / share) / (1 / share).sum())  # both labels alike
        for i in range(0, len(drawn), BATCH):
            some = drawn[i : i + BATCH]
            step += 1
            for p, g, (m, v) in zip(network.parameters(), network.gradients(codes[some], inside[some], labels[some]), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    codes, inside, labels = prepared(held)
    network.scale = _calibrated(network.raw(codes, inside), labels)
    network.threshold = max(0.5, recall_threshold(network.scores(codes, inside), labels, recall))
    return network


def labelled_findings(texts: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> list[Finding]:
    """At most ``per_label`` different candidates of each label, those with the smallest hashes. A candidate is positive if a base finding overlaps it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch.text:
                base = base_spans(text)
                found = candidates(text)
                for (start, end), free in zip(found, uncovered(found, base)):
                    stop = min(end, start + PIECE)
                    rows.append((text[max(0, start - BEFORE) : start], text[start:stop], text[stop : stop + AFTER], int(not free)))
            yield pd.DataFrame(rows, columns=["before", "piece", "after", "label"])

    found = texts.select("text").mapInPandas(run, "before string, piece string, after string, label int")
    # a piece that occurs often counts once; min_by keeps one row per piece and task
    found = found.groupBy("piece", "label").agg(F.min(F.struct("before", "after")).alias("around"))
    ordered = written(found, "secret-findings").withColumn("h", F.xxhash64("piece", "around")).orderBy("h", "piece", "around")
    out = []
    for label in (0, 1):
        for r in ordered.where(F.col("label") == label).limit(per_label).collect():
            out.append(Finding(r.around.before, r.piece, r.around.after, label))
    return out


def _written_spans(spans: list[Span]) -> str:
    return ",".join(f"{[*KINDS, LEARNT][kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", findings: list[Finding] | None = None, per_label: int = SAMPLE_PER_LABEL,
    recall: float = RECALL,
) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans ("kind:start:end" in code points, end exclusive), and n_learnt, the number of spans
    that only the network found: candidates without a base finding whose calibrated score reaches the threshold. ``findings``: labelled examples; by default
    they are taken from ``documents``.

    Defined results: a null text is empty; without findings ``spans`` is empty and base_sha256 that of the empty string. Rows are documents each, whatever their
    ids. Candidates of any length are read whole. If the findings hold one label only, there is no network and only the base findings are
    returned. An empty table gives no rows. Other columns are not read.
    """
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    network = train(labelled_findings(texts, per_label) if findings is None else findings, recall)

    def learnt(texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """The network's spans of each text; pieces of many candidates are scored together."""
        out: list[list[Span]] = [[] for _ in texts]
        held: list[tuple[str, str, str]] = []
        owners: list[tuple[int, int, int]] = []
        hits: set[tuple[int, int, int]] = set()

        def score() -> None:
            if held:
                hits.update(o for o, s in zip(owners, network.scores(*encoded(held))) if s >= network.threshold)
            held.clear()
            owners.clear()

        for i, text in enumerate(texts) if network else ():
            found = candidates(text)
            for (start, end), free in zip(found, uncovered(found, base[i])):
                for piece in pieces(text, start, end) if free else ():
                    held.append(piece)
                    owners.append((i, start, end))
                    if len(held) == PIECES_AT_ONCE:
                        score()
        score()
        for i, start, end in sorted(hits):
            out[i].append((start, len(KINDS), end))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base = [base_spans(t) for t in batch.text]
            rows = []
            for own, more in zip(base, learnt(list(batch.text), base)):
                count = [sum(kind == k for _, kind, _ in own) for k in range(len(KINDS))]
                rows.append((*count, hashlib.sha256(_written_spans(own).encode()).hexdigest(), _written_spans(sorted(own + more)), len(more)))
            frame = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_learnt"])
            frame.insert(0, "doc_id", batch.doc_id.astype("Int64").to_numpy(dtype=object, na_value=None))
            yield frame.astype({"doc_id": "Int64"})

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learnt long"
    return texts.mapInPandas(run, schema)
