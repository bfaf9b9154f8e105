"""Removal of repeated word windows through recompression.

Rounds rename the text: maximal runs of one symbol become one symbol, and pairs of a left and a right symbol become one symbol. Which symbols are left or right in a round
is a bit of their hash, so pairs cannot overlap and equal stretches are renamed alike, but for a few symbols at their ends. Names are 64-bit hashes of what
they stand for: every task gives equal runs and pairs the same global name, without an exchange per round; what Spark exchanges are the
high-level symbols.

For every window of words the rounds tell, from the window alone, between which words the renaming is certain. The window's sign is its first certain
symbol of some length at the highest level that has one; a window without any is its own sign. Equal windows have equal signs, so only signs seen at several places
can belong to a repeat. Windows around such a sign are settled by the hash of all their words together, or else verified one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from layerloom.llm.common import written
from layerloom.llm.repeats import DOCUMENT, keyed_texts, merged, restricted, settle
from layerloom.llm.shingles import mixed

WINDOW = 35
LEVELS = 5
RUN_ROUNDS = (0, 3)  # rounds that also name runs
SIGN_WORDS = 5  # least words of a sign that is not a whole window
BATCH_WORDS = 400_000
ROWS_AT_ONCE = 50_000


def words_of(text: str) -> list[bytes]:
    """Split at space, tab, line feed, vertical tab, form feed and carriage return only."""
    return text.encode("utf-8", "surrogatepass").split()


class _Level:
    """Symbols of one level over a batch of documents: names, first words, document numbers."""

    def __init__(self, names: np.ndarray, starts: np.ndarray, owner: np.ndarray, n_words: int):
        self.names, self.starts, self.owner, self.n_words = names, starts, owner, n_words

    def next_start(self) -> np.ndarray:
        return np.append(self.starts[1:], self.n_words)


def _merge(level: _Level, head: np.ndarray, names: np.ndarray) -> tuple[_Level, np.ndarray]:
    """Keep the symbols marked as heads of their groups; also the new number of each old symbol's group."""
    return _Level(names[head], level.starts[head], level.owner[head], level.n_words), np.cumsum(head) - 1


def rename(names: np.ndarray, owner: np.ndarray, window: int, levels: int = LEVELS) -> Iterator[tuple[_Level, np.ndarray, np.ndarray]]:
    """After each round: the level, and for each word the first certain symbol of the window that begins there and the symbol after the last certain one."""
    n = len(names)
    level = _Level(names, np.arange(n), owner, n)
    first = np.arange(n)  # number of the first certain symbol
    last = np.minimum(np.arange(n) + window, n)  # and of the one behind the last
    for number in range(levels):
        if number in RUN_ROUNDS:
            names, same = level.names, np.zeros(len(level.names), bool)
            same[1:] = (names[1:] == names[:-1]) & (level.owner[1:] == level.owner[:-1])
            head = ~same
            places = np.flatnonzero(head)
            run = np.diff(np.append(places, len(names)))
            renamed = names.copy()
            long = run > 1
            renamed[places[long]] = mixed(names[places[long]] ^ mixed(run[long].astype(np.uint64) + np.uint64(number << 40)))
            level, group = _merge(level, head, renamed)
            # the runs at both ends may go on outside
            first = group[np.minimum(first, len(group) - 1)] + 1
            last = group[np.maximum(last - 1, 0)]
        names = level.names
        right = (mixed(names ^ mixed(np.full(1, number + 1, np.uint64))) & np.uint64(1)).astype(bool)
        paired = np.zeros(len(names), bool)  # with the symbol before
        paired[1:] = right[1:] & ~right[:-1] & (level.owner[1:] == level.owner[:-1])
        renamed = names.copy()
        lead = np.flatnonzero(paired) - 1
        renamed[lead] = mixed(mixed(names[lead]) + names[lead + 1])
        # a right symbol at the beginning may belong to a pair, and so may a left symbol at the end
        inside = np.minimum(first, len(names) - 1)
        first = first + (right[inside] & (first < len(names)))
        end = np.clip(last - 1, 0, len(names) - 1)
        last = last - (~right[end] & (last > 0))
        level, group = _merge(level, ~paired, renamed)
        bounded = np.append(group, group[-1] + 1 if len(group) else 0)
        first, last = bounded[np.minimum(first, len(group))], bounded[np.clip(last, 0, len(group))]
        yield level, first, last


def signs(names: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window (by its first word): its first word, the word its sign begins at (with the level), and the sign's name."""
    n, owner = len(names), np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    windows = np.flatnonzero(place + window <= np.repeat(counts, counts))
    at, name = np.full(n, -1, np.int64), np.zeros(n, np.uint64)
    if not len(windows):
        return windows, at[windows], name[windows]
    for number, (level, first, last) in enumerate(rename(names, owner, window)):
        size = level.next_start() - level.starts
        # the next symbol of enough words, from each symbol on
        following = np.where(size >= SIGN_WORDS, np.arange(len(size)), len(size))
        following = np.append(np.minimum.accumulate(following[::-1])[::-1], len(size))
        sign = following[np.minimum(first[windows], len(size))]
        has = sign < last[windows]
        hit = windows[has]
        at[hit] = level.starts[sign[has]] * (LEVELS + 1) + number + 1  # higher levels replace lower ones
        name[hit] = mixed(level.names[sign[has]] + np.uint64(number + 1))
    return windows, at[windows], name[windows]


def _documents(batch: pd.DataFrame) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Documents with their words, in runs of a bounded number of words."""
    keys, texts, size = [], [], 0
    for key, text in zip(zip(batch.doc_id.astype("Int64"), batch.text_key), batch.text):
        words = words_of(text)
        if texts and size + len(words) > BATCH_WORDS:
            yield keys, texts
            keys, texts, size = [], [], 0
        keys.append(key)
        texts.append(words)
        size += len(words)
    if texts:
        yield keys, texts


def find_signs(texts: DataFrame, window: int) -> DataFrame:
    """doc_id, text_key, low and high (first and last window of a run of windows with one sign), key, context of every sign."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for docs, words in _documents(batch):
                counts = np.fromiter(map(len, words), np.int64, len(words))
                if counts.max() < window:
                    continue
                codes, distinct = pd.factorize(np.concatenate([np.array(w, dtype=object) for w in words if w]))
                names = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[codes]
                at_word, at, name = signs(names, counts, window)
                packed = names.tobytes()
                ends = np.cumsum(counts)
                doc = np.searchsorted(ends, at_word, "right")
                alone = at < 0
                new = np.ones(len(at), bool)
                new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | alone[1:] | alone[:-1]
                low, group_doc = at_word[new], doc[new]
                high = at_word[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
                keys, contexts = name[new], np.zeros(len(low), np.uint64)
                offset = at[new] // (LEVELS + 1) - low  # where in the surroundings the sign stands
                for i, (a, b, o, whole) in enumerate(zip(low.tolist(), high.tolist(), offset.tolist(), alone[new].tolist())):
                    contexts[i] = xxhash.xxh3_64_intdigest(packed[8 * a : 8 * (b + window)], seed=max(o, 0))
                    if whole:
                        keys[i] = contexts[i]
                begin = (ends - counts)[group_doc]
                yield pd.DataFrame({
                    "doc_id": pd.array([docs[d][0] for d in group_doc], "Int64"), "text_key": [docs[d][1] for d in group_doc],
                    "low": low - begin, "high": high - begin, "key": keys.view(np.int64), "context": contexts.view(np.int64),
                })

    return texts.mapInPandas(run, "doc_id long, text_key long, low long, high long, key long, context long")


def _verified(texts: DataFrame, left: DataFrame, window: int) -> DataFrame:
    """doc_id, text_key, low, high of the windows around open signs whose whole word sequence is met at another place too."""
    places = left.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("low", "high", "alone")).alias("places"))
    # equal rows come twice, which is harmless: their surroundings are not alone
    joined = restricted(texts, places).join(places.drop("doc_id"), "text_key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text_key, text, places in zip(batch.doc_id, batch.text_key, batch.text, batch.places):
                words = words_of(text)
                rows += [
                    (doc_id, text_key, s, p["alone"], xxhash.xxh3_128_digest(b" ".join(words[s : s + window])))
                    for p in places for s in range(p["low"], p["high"] + 1)
                ]
                if len(rows) > ROWS_AT_ONCE:
                    yield frame_of(rows)
                    rows = []
            yield frame_of(rows)

    def frame_of(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=[*DOCUMENT, "low", "alone", "window"])
        return frame.astype({"doc_id": "Int64", "text_key": "int64", "low": "int64", "alone": bool})

    schema = "doc_id long, text_key long, low long, alone boolean, window binary"
    found = written(joined.select("doc_id", "text_key", "text", "places").mapInPandas(run, schema), "sign-windows")
    # one row per distinct surroundings was sent, so a window met in two of them is repeated; equal documents are counted by their surroundings
    twice = found.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.max((~F.col("alone")).cast("int")).alias("copied")).where("n > 1 or copied = 1")
    hit = found.where("alone").join(twice.select("window"), "window", "left_semi")
    return hit.select(*DOCUMENT, "low", F.col("low").alias("high"))


def repeated_words(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key and ``ranges`` (start and stop in words, not yet merged) of the documents that hold a repeated window."""
    found = written(find_signs(texts, window), "signs")
    settled, left = settle(found, ["low", "high"])
    every = settled.unionByName(_verified(texts, left, window))
    ranges = every.select(*DOCUMENT, F.col("low").alias("start"), (F.col("high") + window).alias("stop"))
    ranges = ranges.distinct().groupBy(*DOCUMENT).agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    return written(ranges, "repeated-words")


def remove_repeated_words(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and kept (the words left, joined by one space).

    Defined results: null text has no words; texts shorter than a window lose nothing. A window met twice in one document counts as repeated, overlapping itself or
    not. Rows with equal ids are separate documents. An empty table gives no rows. Other columns are not read.
    """
    texts = keyed_texts(documents, id_column, text_column)
    ranges = repeated_words(texts, window).select("text_key", "ranges")
    hit = restricted(texts, ranges).join(ranges, "text_key").select("doc_id", "text", "ranges")
    none = F.lit(None).cast(ranges.schema["ranges"].dataType)
    rest = restricted(texts, ranges, others=True).select("doc_id", "text", none.alias("ranges"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(batch.doc_id.astype("Int64"), batch.text, batch.ranges):
                words = words_of(text)
                kept, at = [], 0
                for a, b in [] if found is None else merged([r["start"] for r in found], [r["stop"] for r in found]):
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                joined = b" ".join(kept)
                rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "replace")))
            frame = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
            yield frame.astype({"doc_id": "Int64"})

    return hit.unionByName(rest).mapInPandas(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
