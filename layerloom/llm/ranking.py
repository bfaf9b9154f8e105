"""Ranked lexical search by presence masks.

Documents are read once into postings of the items' terms. A block of documents gives every term a bitmap of the documents that hold it; an item's bitmaps
together give each document a mask of the matched terms, and documents with the same mask form a group. A mask's maximum score adds up the largest
contribution that each of its terms makes anywhere in the block. Masks are evaluated by descending maximum, and an item is finished with a block as soon as
the next maximum is below the k-th score that the task has found so far: no document of the masks left can be among the k best.

Each task keeps k documents per item, so what is exchanged is k rows per task and item, however common a term is.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from layerloom.llm.common import whole_text, written

BEST = 10
BLOCK = 4096  # documents whose bitmaps are in memory at once
# Items are searched in waves of about this many characters, so that what is sent to every task has a bound.
WAVE_CHARACTERS = 4_000_000
BITS = 62  # of a mask in one integer
EVALUATED_AT_ONCE = 128
LARGEST = 2**63 - 1

# A-Z in lower case, every other ASCII character but digits and letters a space; bytes of longer characters stay.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text with repeats, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def term_weight(n_documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * frequency + 1)))


def lengths(words: np.ndarray, n_documents: int, n_words: int) -> np.ndarray:
    """m of each document."""
    if len(words) and int(words.max()) * 75 * n_documents > LARGEST:
        return np.array([25 + 75 * int(n) * n_documents // n_words for n in words], dtype=np.int64)
    return 25 + 75 * words * n_documents // n_words


def mask_groups(present: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a document of each distinct mask, the mask's number for each document, documents of each mask). ``present``: a bitmap for each term."""
    code = np.zeros(present.shape[1], np.int64)
    for at in range(0, len(present), BITS):
        bits = present[at : at + BITS]
        more = (np.int64(1) << np.arange(len(bits), dtype=np.int64)) @ bits
        if at:
            values, more = np.unique(more, return_inverse=True)
            code = np.unique(code, return_inverse=True)[1] * len(values) + more
        else:
            code = more
    _, first, group, size = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
    return first, group, size


class Best:
    """The k best documents so far: highest score, then smallest id, a null id last."""

    def __init__(self, k: int):
        self.k, self.floor = k, 0
        self.scores, self.unknown, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, unknown: np.ndarray, ids: np.ndarray) -> None:
        good = (scores > 0) & (scores >= self.floor)
        if not good.any():
            return
        scores, unknown, ids = np.r_[self.scores, scores[good]], np.r_[self.unknown, unknown[good]], np.r_[self.ids, ids[good]]
        order = np.lexsort((ids, unknown, -scores))[: self.k]
        self.scores, self.unknown, self.ids = scores[order], unknown[order], ids[order]
        if len(order) == self.k:
            self.floor = int(self.scores[-1])


def search_block(present: np.ndarray, share: np.ndarray, gains: np.ndarray, unknown: np.ndarray, ids: np.ndarray, best: Best) -> int:
    """Add the block's documents that may be among the best; returns how many were evaluated. ``share``: the part of the score that a term has in a document
    before its weight, ``gains``: the weight of each term, repeats included."""
    first, group, size = mask_groups(present)
    highest = (gains * share.max(axis=1)) @ present[:, first]
    order = np.argsort(-highest, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    documents, ends = np.argsort(place[group], kind="stable"), np.cumsum(size[order])
    at = seen = 0
    while at < len(order) and highest[order[at]] > 0 and highest[order[at]] >= best.floor:
        at = int(np.searchsorted(ends, seen + EVALUATED_AT_ONCE)) + 1
        here = documents[seen : ends[min(at, len(order)) - 1]]
        best.add(gains @ share[:, here], unknown[here], ids[here])
        seen += len(here)
    return seen


def _postings(texts: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """doc_id, n (words), and the items' terms in the document with their counts, for every document with words."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, terms, counts, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms_of(text.as_py())
                if words:
                    held = [(places[t], c) for t, c in Counter(words).items() if t in places]
                    terms += [p for p, _ in held]
                    counts += [c for _, c in held]
                    ids.append(doc_id)
                    sizes.append(len(words))
                    ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], schema=schema)

    return texts.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def _search_wave(texts: DataFrame, items: list[tuple[int, Counter]], k: int) -> DataFrame:
    """item (its number), doc_id, score: at most k rows per item and task."""
    spark = texts.sparkSession
    places = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    postings = written(_postings(texts, places), "ranking-postings")
    n_documents, n_words = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_documents or not places:
        return spark.createDataFrame([], "item int, doc_id long, score long")
    weights = np.zeros(len(places), np.int64)
    for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row per term of the wave at most
        weights[row.term] = term_weight(n_documents, row["count"])
    wanted = []
    for number, terms in items:
        own = np.array([places[t] for t in terms], dtype=np.int64)
        if len(own):
            wanted.append((number, own, np.array(list(terms.values()), dtype=np.int64) * weights[own]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: Best(k) for number, _, _ in wanted}

        def search(held: list[pa.RecordBatch]) -> None:
            block = pa.Table.from_batches(held)
            n = block.num_rows
            ids = block.column("doc_id").combine_chunks()
            unknown, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            m = lengths(block.column("n").to_numpy(), n_documents, n_words)
            lists = block.column("terms").combine_chunks()
            owner = np.repeat(np.arange(n), lists.value_lengths().to_numpy())
            terms, counts = lists.flatten().to_numpy(), block.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
            order = np.argsort(terms, kind="stable")
            terms, owner, counts = terms[order], owner[order], counts[order]
            part = 1_000_000_000 * counts // (1000 * counts + 8 * m[owner])
            starts = np.searchsorted(terms, np.arange(len(places) + 1))
            for number, own, gains in wanted:
                present, share = np.zeros((len(own), n), bool), np.zeros((len(own), n), np.int64)
                for i, t in enumerate(own):
                    here = slice(starts[t], starts[t + 1])
                    present[i, owner[here]] = True
                    share[i, owner[here]] = part[here]
                search_block(present, share, gains, unknown, ids, best[number])

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK:
                search(held)
                held, rows = [], 0
        if rows:
            search(held)
        for number, found in best.items():
            if len(found.ids):
                named = pa.array(found.ids, pa.int64(), mask=found.unknown)
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(found.ids), pa.int32()), named, pa.array(found.scores, pa.int64())], ["item", "doc_id", "score"])

    return postings.mapInArrow(run, "item int, doc_id long, score long")


def ranked_search(
    documents: DataFrame, items: DataFrame, k: int = BEST, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    wave_characters: int = WAVE_CHARACTERS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of each item with the highest score above 0, equal scores by ascending doc_id.

    Defined results: null texts and texts without terms have no terms: such documents count nowhere and such items get no rows. Rows of ``documents`` are
    documents each, whatever their ids; a null id comes last among equal scores. Rows of ``items`` with equal id and text are one item; equal ids with different
    texts are ranked each by itself. Very long texts count whole. Without documents or items there are no rows. Other columns are not read.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    asked = written(items.select(F.col(item_column).cast("long").alias("item_id"), whole_text(text_column).alias("text")).distinct(), "ranking-items")
    n_waves = max(1, -(-(asked.agg(F.sum(F.length("text"))).first()[0] or 0) // wave_characters))
    wave = F.pmod(F.xxhash64("text", "item_id"), F.lit(n_waves))
    out = None
    for i in range(n_waves):
        rows = asked.where(wave == i).collect()  # one wave of the items
        names = spark.createDataFrame([(n, r.item_id) for n, r in enumerate(rows)], "item int, item_id long")
        found = _search_wave(texts, [(n, Counter(terms_of(r.text))) for n, r in enumerate(rows)], k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = ranked if out is None else out.unionByName(written(ranked, "ranking-found"))
    return out
