"""Removal of repeated substrings through a common-prefix interval tree over an enhanced suffix array.

The suffix array holds the suffixes at anchors only: in every window of positions the one whose 16-byte string has the smallest hash (the leftmost of
equals). A repeated string of 400 bytes has an anchor among its first positions, at the same place in all its occurrences, and at least 216 bytes
from there on; so only anchors that share these 216 bytes can matter, and these are dealt out by them. Each part is sorted by what
follows the anchors, with the common-prefix length of neighbours beside it. A stack scan turns these lengths into the tree of intervals; every interval is a set of
places that continue alike for its depth. Within an interval the places are lined up by what precedes them: where they differ there, the repeat is
maximal to the left, and the longest common piece of a place with any other of the interval says how far the repeat reaches back. Depth plus reach of 400 or more is a repeat,
with all its occurrences.

Anchors whose whole surroundings (all that a 400-byte window around them can hold) occur several times need no tree and are settled by counting. Keys with
more distinct surroundings than a task should hold are settled window by window, also by counting.

Passages can also be sought by words: the array is then built over texts in which every short word is padded to a least size (``spread``), so that a
number of words has a least length whatever the words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from layerloom.llm.common import parts_for, whole_text, written
from layerloom.llm.repeats import DOCUMENT, keyed_texts, merged, restricted, settle
from layerloom.llm.shingles import mixed

LENGTH = 400
GRAM = 16
# Distinct surroundings of one key that one task takes, at most.
TREE_ROWS = 65_536
BATCH_BYTES = 1 << 18
ROWS_AT_ONCE = 20_000
PAD = 0xFF  # no byte of UTF-8
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _reach(length: int) -> int:
    """Positions in a window of which one is chosen; the anchor stands at most this less one behind the window's start."""
    return max(1, length * 46 // 100)


def _as_bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _padding(data: bytes, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every word of ``data``, and what it lacks, with the white space behind it, to ``unit`` bytes."""
    blank = BLANK[np.frombuffer(data, np.uint8)]
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    return starts, np.maximum(unit - np.diff(np.r_[starts, len(data)]), 0)


def spread(data: bytes, unit: int) -> bytes:
    """``data`` with padding before every word that is shorter than ``unit`` with the white space behind it; white space of any kind is a space.

    Padding depends on its word alone, so a common string of two texts stays common up to its last word, which may go on differently and is then short:
    the string loses ``unit`` - 1 bytes at most."""
    raw = np.frombuffer(data, np.uint8)
    starts, lacking = _padding(data, unit)
    before = np.zeros(len(raw), np.int64)
    before[starts] = lacking
    out = np.full(len(raw) + int(lacking.sum()), PAD, np.uint8)
    out[np.arange(len(raw)) + np.cumsum(before)] = np.where(BLANK[raw], 0x20, raw)
    return out.tobytes()


def unspread(data: bytes, unit: int, places: np.ndarray) -> np.ndarray:
    """Where places of ``spread(data, unit)`` are in ``data``; padding is at the start of its word."""
    starts, lacking = _padding(data, unit)
    if not len(starts):
        return places
    begins = starts + np.cumsum(lacking) - lacking
    word = np.searchsorted(begins, places, "right") - 1
    return np.where(word < 0, places, starts[word] + np.maximum(places - begins[word] - lacking[word], 0))


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: running minima of blocks from both sides."""
    n = len(values) - width + 1
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors_of(data: bytes, bounds: list[tuple[int, int]], length: int) -> np.ndarray:
    """Anchor positions in ``data``, for the documents that lie at the given bounds, at most 2^24 bytes in all."""
    reach = _reach(length)
    bounds = [(a, b) for a, b in bounds if b - a >= length]
    if not bounds:
        return np.zeros(0, np.int64)
    gram = np.frombuffer(data + bytes(GRAM), np.uint8).astype(np.uint64)
    base, step = np.uint64(0x9E3779B97F4A7C15), 1
    while step < GRAM:  # hashes of 2, 4, 8, 16 bytes
        gram = gram[:-step] * base + gram[step:]
        gram = mixed(gram)
        step *= 2
    place = np.arange(len(gram), dtype=np.uint64)
    least = _minima(gram & ~np.uint64(0xFFFFFF) | place, reach)
    chosen = [np.unique(least[a : b - length + 1] & np.uint64(0xFFFFFF)) for a, b in bounds]
    return np.concatenate(chosen).astype(np.int64)


def _batched(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of a bounded total size; a longer text comes alone."""
    begin = 0
    while begin < len(texts):
        end, size = begin + 1, len(texts[begin])
        while end < len(texts) and size + len(texts[end]) <= BATCH_BYTES:
            size += len(texts[end])
            end += 1
        yield begin, texts[begin:end]
        begin = end


def _pieces(text: bytes, length: int, size: int = BATCH_BYTES) -> Iterator[tuple[int, bytes]]:
    """A long text in overlapping pieces: every window of ``length`` lies in one whole."""
    step = size - length
    for start in range(0, max(len(text) - length, 0) + 1, step):
        yield start, text[start : start + size]


def find_anchors(texts: DataFrame, length: int, encode: Callable[[str], bytes] = _as_bytes) -> DataFrame:
    """doc_id, text_key, position, key, context of every anchor."""
    reach = _reach(length)
    sure = length - reach  # bytes from the anchor on that every window holds

    def rows(doc, start: int, data: bytes, places: np.ndarray, whole: bytes) -> list[tuple]:
        out = []
        for p in places.tolist():
            at = start + p
            left = min(at, reach - 1)
            key = xxhash.xxh3_64_intdigest(whole[at : at + sure])
            context = xxhash.xxh3_64_intdigest(whole[at - left : at + length], seed=left)
            out.append((*doc, at, key, context))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            encoded = [encode(t) for t in batch.text]
            docs = list(zip(batch.doc_id.astype("Int64"), batch.text_key))
            for begin, group in _batched(encoded):
                found: list[tuple] = []
                if len(group) == 1 and len(group[0]) > BATCH_BYTES:
                    seen: set[int] = set()
                    for start, piece in _pieces(group[0], length):
                        places = anchors_of(piece, [(0, len(piece))], length)
                        places = np.array([p for p in places.tolist() if start + p not in seen], np.int64)
                        seen = {start + p for p in places.tolist()}
                        found += rows(docs[begin], start, piece, places, group[0])
                else:
                    sizes = np.cumsum([0, *map(len, group)])
                    data = b"".join(group)
                    places = anchors_of(data, list(zip(sizes[:-1].tolist(), sizes[1:].tolist())), length)
                    cuts = np.searchsorted(places, sizes)
                    for i, text in enumerate(group):
                        found += rows(docs[begin + i], 0, text, places[cuts[i] : cuts[i + 1]] - sizes[i], text)
                if found:
                    frame = pd.DataFrame(found, columns=[*DOCUMENT, "position", "key", "context"])
                    for c in ("key", "context"):
                        frame[c] = np.array([f[3 if c == "key" else 4] for f in found], np.uint64).view(np.int64)
                    yield frame

    return texts.mapInPandas(run, "doc_id long, text_key long, position long, key long, context long")


def _common(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of two byte matrices, at most ``sizes``."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(first, sizes)


def _padded(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    data = b"".join(s.ljust(width, b"\0") for s in strings)
    return np.frombuffer(data, np.uint8).reshape(len(strings), width), sizes


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval of the tree over the common-prefix lengths of neighbours, inner ones first."""
    stack = [(-1, 0)]
    for i, depth in enumerate([*common, -1]):
        first = i
        while stack[-1][0] > depth:
            inner, first = stack.pop()
            yield inner, first, i
        if stack[-1][0] < depth:
            stack.append((depth, first))


def maximal_repeats(before: list[bytes], after: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For places that share a beginning of ``after``: how far back and ahead the repeats of at least ``length`` around each place reach; 0 and 0
    without any. ``before`` is read backwards from the place."""
    n = len(after)
    order = np.array(sorted(range(n), key=after.__getitem__))
    back = [s[::-1] for s in before]
    rank = np.empty(n, np.int64)
    rank[sorted(range(n), key=back.__getitem__)] = np.arange(n)
    reach = max(max(map(len, back)), 1)
    behind, behind_sizes = _padded(back, reach)
    ahead, ahead_sizes = _padded([after[i] for i in order], length)
    common = _common(ahead[1:], ahead[:-1], np.minimum(ahead_sizes[1:], ahead_sizes[:-1]))
    far_back, far_ahead = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for depth, first, last in intervals(common.tolist()):
        if depth + reach < length:
            continue
        inside = order[first : last + 1]
        inside = inside[np.argsort(rank[inside])]
        same = _common(behind[inside[1:]], behind[inside[:-1]], np.minimum(behind_sizes[inside[1:]], behind_sizes[inside[:-1]]))
        longest = np.maximum(np.r_[0, same], np.r_[same, 0])  # with the nearer of the two neighbours
        long = longest + depth >= length
        hit = inside[long]
        far_back[hit] = np.maximum(far_back[hit], longest[long])
        far_ahead[hit] = np.maximum(far_ahead[hit], depth)
    return far_back, far_ahead


def _surroundings(texts: DataFrame, left: DataFrame, length: int, encode: Callable[[str], bytes]) -> DataFrame:
    """Adds what stands before and after each open anchor."""
    reach = _reach(length)
    places = left.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("position", "key", "alone")).alias("places"))
    joined = restricted(texts, places).join(places.drop("doc_id"), "text_key")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text_key, text, places in zip(batch.doc_id, batch.text_key, batch.text, batch.places):
                data = encode(text)
                rows += [
                    (doc_id, text_key, p["position"], p["key"], p["alone"], data[max(p["position"] - reach + 1, 0) : p["position"]],
                     data[p["position"] : p["position"] + length]) for p in places
                ]
                if len(rows) > ROWS_AT_ONCE:
                    yield frame_of(rows)
                    rows = []
            yield frame_of(rows)

    def frame_of(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=[*DOCUMENT, "position", "key", "alone", "before", "after"])
        return frame.astype({"doc_id": "Int64", "text_key": "int64", "position": "int64", "key": "int64", "alone": bool})

    schema = "doc_id long, text_key long, position long, key long, alone boolean, before binary, after binary"
    # equal rows come twice, which is harmless: their surroundings are not alone
    return joined.select("doc_id", "text_key", "text", "places").mapInPandas(cut, schema)


def _by_tree(around: DataFrame, length: int, parts: int) -> DataFrame:
    """doc_id, text_key, start, stop of what the tree finds around anchors that are alone with their surroundings."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key", kind="stable", ignore_index=True)
        keys = part.key.to_numpy()
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        back, ahead = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        before, after = part.before.tolist(), part.after.tolist()
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                back[a:b], ahead[a:b] = maximal_repeats(before[a:b], after[a:b], length)
        found = part.assign(start=part.position - back, stop=part.position + ahead)
        return found.loc[(ahead > 0) & part.alone, [*DOCUMENT, "start", "stop"]]

    dealt = around.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInPandas(lambda f: run(f.drop(columns="part")), "doc_id long, text_key long, start long, stop long")


def _by_window(around: DataFrame, length: int) -> DataFrame:
    """The same for keys too common for one task: every window around an anchor by its hash, counted."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text_key, position, alone, before, after in zip(batch.doc_id, batch.text_key, batch.position, batch.alone, batch.before, batch.after):
                whole = before + after
                for s in range(len(whole) - length + 1):
                    digest = xxhash.xxh3_128_digest(whole[s : s + length])
                    rows.append((doc_id, text_key, position - len(before) + s, alone, digest))
            frame = pd.DataFrame(rows, columns=[*DOCUMENT, "start", "alone", "window"])
            yield frame.astype({"doc_id": "Int64", "text_key": "int64", "start": "int64", "alone": bool})

    found = written(around.mapInPandas(windows, "doc_id long, text_key long, start long, alone boolean, window binary"), "common-windows")
    # One window can be seen from two anchors of its document; places are counted, not sightings.
    span = F.struct(*DOCUMENT, "start")
    twice = found.groupBy("window").agg(F.min(span).alias("low"), F.max(span).alias("high")).where("low <> high").select("window")
    hit = found.where("alone").join(twice, "window", "left_semi")
    return hit.select(*DOCUMENT, "start", (F.col("start") + length).alias("stop")).distinct()


def repeated_ranges(texts: DataFrame, length: int = LENGTH, tree_rows: int = TREE_ROWS, *, encode: Callable[[str], bytes] = _as_bytes) -> DataFrame:
    """doc_id, text_key and ``ranges`` (a list of start and stop, not yet merged) of the documents that hold a repeated string, in the texts as encoded."""
    reach = _reach(length)
    anchors = written(find_anchors(texts, length, encode), "suffix-anchors")
    settled, left = settle(anchors, ["position"])
    around = written(_surroundings(texts, left, length, encode), "suffix-surroundings")
    common = around.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tree_rows).select("key")
    common = written(common, "common-keys")
    hot = common.limit(1).count() > 0
    usual = around.join(common, "key", "left_anti") if hot else around
    # settled anchors: everything around them as far as the document goes
    whole = settled.select(*DOCUMENT, F.greatest(F.col("position") - (reach - 1), F.lit(0)).alias("start"), (F.col("position") + length).alias("stop"))
    found = whole.unionByName(_by_tree(usual, length, 8 * parts_for(texts)))
    if hot:
        found = found.unionByName(_by_window(around.join(common, "key", "left_semi"), length))
    ranges = found.distinct().groupBy(*DOCUMENT).agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    return written(ranges, "repeated-ranges")


def _cut_out(data: bytes, ranges) -> tuple[list[tuple[int, int]], bytes]:
    spans = merged([r["start"] for r in ranges], [min(r["stop"], len(data)) for r in ranges])
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    return spans, b"".join([*kept, data[at:]])


def remove_repeats(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, words: int | None = None
) -> DataFrame:
    """All columns of ``documents``, the text without every byte that lies in a string of ``length`` bytes found elsewhere too.

    With ``words``, passages of that many words go as well, however short the words: a word, with the white space behind it, then counts as
    ``length // words`` bytes at least, and white space of any kind is alike. What shares no ``length`` bytes as they stand can so be a repeat from
    ``length`` less a word on.

    A character that loses some of its bytes goes. A column n_chars, if there, is counted anew. Rows whose text loses nothing are as before (a null text
    stays null). Other defined results: see ``digests``.
    """
    columns = [f"own_{i}" for i in range(len(documents.columns))]  # own names cannot clash with what is joined
    own = documents.toDF(*columns)
    text, doc_id = (columns[documents.columns.index(c)] for c in (text_column, id_column))
    texts = keyed_texts(documents, id_column, text_column)
    unit = length // words if words else 1
    if unit > 1:
        # A string of ``length`` bytes keeps all but unit - 1 of them when spread, so texts without a range of the first kind have none of the second.
        by_words = repeated_ranges(texts, length - unit + 1, encode=lambda t: spread(_as_bytes(t), unit))
        by_bytes = repeated_ranges(restricted(texts, by_words), length).select("text_key", "ranges")
        ranges = by_words.select("text_key", F.col("ranges").alias("spread")).join(by_bytes, "text_key", "left")
    else:
        ranges = repeated_ranges(texts, length).select("text_key", F.lit(None).cast("array<struct<start:long,stop:long>>").alias("spread"), "ranges")
    ranges = ranges.select("text_key", F.struct(F.col("spread"), F.col("ranges").alias("bytes")).alias("ranges"))
    marked = own.withColumn("text_key", F.xxhash64(whole_text(text), F.col(doc_id).cast("long"))).join(ranges, "text_key", "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, by_words: pd.Series, by_bytes: pd.Series) -> pd.Series:
        kept = [t if a is None and b is None else without(t.encode("utf-8", "surrogatepass"), a, b) for t, a, b in zip(texts, by_words, by_bytes)]
        return pd.Series(kept, dtype=object)

    def without(data: bytes, by_words, by_bytes) -> str:
        found = [] if by_bytes is None else list(by_bytes)
        if by_words is not None:
            edges = unspread(data, unit, np.array([(r["start"], r["stop"]) for r in by_words], np.int64).reshape(-1, 2))
            found += [{"start": a, "stop": b} for a, b in edges.tolist()]
        return _cut_out(data, found)[1].decode("utf-8", "ignore")

    result = marked.withColumn(text, cut(F.col(text).cast("string"), "ranges.spread", "ranges.bytes"))
    if "n_chars" in documents.columns:
        n_chars = columns[documents.columns.index("n_chars")]
        result = result.withColumn(n_chars, F.when(F.col("ranges").isNull(), F.col(n_chars)).otherwise(F.length(text).cast("long")))
    return result.select(*columns).toDF(*documents.columns)


def digests(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Defined results: null text is empty; texts shorter than ``length`` lose nothing. A string that occurs twice in one document counts as repeated,
    overlapping itself or not. Rows with equal ids are separate documents. An empty table gives no rows. Other columns are not read.
    """
    texts = keyed_texts(documents, id_column, text_column)
    ranges = repeated_ranges(texts, length)
    hit = restricted(texts, ranges).join(ranges.drop("doc_id"), "text_key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(batch.doc_id.astype("Int64"), batch.text, batch.ranges):
                data = text.encode("utf-8", "surrogatepass")
                spans, kept = _cut_out(data, found)
                rows.append((doc_id, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            frame = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            yield frame.astype({"doc_id": "Int64"})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    cut = hit.select("doc_id", "text", "ranges").mapInPandas(run, schema)
    zero = F.lit(0).cast("long")
    rest = restricted(texts, ranges, others=True)
    whole = rest.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256")
    )
    return cut.unionByName(whole)

