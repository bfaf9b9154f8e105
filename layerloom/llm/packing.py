"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing: each partition packs its pieces best-fit (longest first) into bins and emits the bins that are nearly full.
The underfull bins are the items of the next round, packed again best-fit in fewer partitions, until one small partition is left or merging no longer
helps. The first round has a leaf for every partition of the session, of at least ``LEAF`` pieces, whatever the size of the input. Full pieces are sequences at once. Every round's result is a written table.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layerloom.llm import pretokens
from layerloom.llm.common import parts_for, whole_text, written

END = 2
SEQUENCE = 1024
# A bin with at most this much room is final.
SLACK = 4
# Bins that one task of a round takes, about.
BINS_PER_TASK = 200_000
# Pieces that a leaf of the first round has at least: fewer would be too few to fill bins well.
LEAF = 500
# Units in each of the two generations that a worker remembers. Workers outlive a stage, so this memory (about 25 MB) stays beside whatever runs next.
UNITS_KNOWN = 75_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
BINNED = PIECES + ", part long, bin long, offset long, done boolean"


class Encoder:
    """Ids of whole texts by the tokenizer itself, which sees a unit again only if it was not met lately (two generations of bounded size)."""

    def __init__(self, path: str, memory: int = UNITS_KNOWN):
        self.tokenizer, self.memory = pretokens.load(path), memory
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.shown = {b: c for c, b in pretokens.byte_characters().items()}

    def _learn(self, units: list[str]) -> None:
        if len(self.known) > self.memory:
            self.older, self.known = self.known, {}
        model, shown = self.tokenizer.model, self.shown
        for unit in set(units):
            if unit not in self.known:
                ids = self.older.get(unit)
                if ids is None:
                    # the splitter's work is done; the model wants a printable character for each byte
                    tokens = model.tokenize(unit.encode("utf-8", "surrogatepass").decode("latin-1").translate(shown))
                    ids = array("I", [t.id for t in tokens]).tobytes()
                self.known[unit] = ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if pretokens.SPECIAL in text:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        out = []
        for part in pretokens.pieces(text):
            units = pretokens.units(part, self.tokenizer)
            try:
                out.append(b"".join(map(self.known.__getitem__, units)))
            except KeyError:
                self._learn(units)
                out.append(b"".join(map(self.known.__getitem__, units)))
        return b"".join(out)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(ids: bytes, size: int = SEQUENCE) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of each piece of a document; all but the first are full."""
    n = len(ids) // 4
    first = (n - 1) % size + 1 if n else 0
    bounds = [0, *range(first, n + 1, size)]
    return [(a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for a, b in zip(bounds, bounds[1:])]


def token_pieces(
    documents: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", size: int = SEQUENCE, end: int = END
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    mark = np.asarray([end], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows = [
                (doc_id, k, start, length, crc)
                for doc_id, text in zip(batch.doc_id, batch.text)
                for k, (start, length, crc) in enumerate(cut(encode(text) + mark, size))
            ]
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    return texts.mapInPandas(run, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins: longest first, each into the fullest bin with room for it.

    Bins with equal room wait in one stack per room; a bit set of the rooms in use gives the smallest that suffices.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, n_bins = 0, 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        mask = used >> size
        if mask:
            room = size + (mask & -mask).bit_length() - 1
            target = stacks[room].pop()
            if not stacks[room]:
                used &= ~(1 << room)
        else:
            room, target = capacity, n_bins
            n_bins += 1
        bins[item], offsets[item] = target, capacity - room
        stacks[room - size].append(target)
        if room > size:
            used |= 1 << (room - size)
    return bins, offsets, n_bins


def _packed(rows: pd.DataFrame, capacity: int, slack: int, final: bool) -> pd.DataFrame:
    """Pack the bins of ``rows`` (part, bin) as items; their pieces move along with them."""
    rows = rows.sort_values(["part", "bin", "offset"], kind="stable", ignore_index=True)
    code = (rows[["part", "bin"]] != rows[["part", "bin"]].shift()).any(axis=1).cumsum().to_numpy() - 1
    sizes = np.bincount(code, weights=rows["length"]).astype(np.int64)
    bins, offsets, n_bins = best_fit(sizes, capacity)
    filled = np.bincount(bins, weights=sizes, minlength=n_bins)
    rows["bin"] = bins[code]
    rows["offset"] = rows["offset"].to_numpy() + offsets[code]
    rows["done"] = final | (capacity - filled[bins[code]] <= slack)
    return rows


def _round(items: DataFrame, parts: int, number: int, capacity: int, final: bool, slack: int = SLACK) -> DataFrame:
    """One round: items dealt by a hash of their bin (all pieces of a bin together), packed per part."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["group"].iloc[0])
        out = _packed(rows.drop(columns="group"), capacity, slack, final)
        out["part"] = (number << 32) + group  # one task numbered its bins
        return out

    dealt = items.withColumn("group", F.pmod(F.xxhash64("part", "bin", F.lit(number)), F.lit(parts)))
    return dealt.groupBy("group").applyInPandas(run, BINNED)


def pack(pieces: DataFrame, capacity: int = SEQUENCE, bins_per_task: int = BINS_PER_TASK, slack: int = SLACK) -> DataFrame:
    """Add sequence_id and offset to pieces of at most ``capacity`` tokens. ``pieces`` must be a stored table."""
    too_long = pieces.where((F.col("length") > capacity) | (F.col("length") < 1)).limit(1).count()
    if too_long:
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    full = pieces.where(F.col("length") == capacity).select(
        "*", F.lit(0).cast("long").alias("part"), F.monotonically_increasing_id().alias("bin"), F.lit(0).cast("long").alias("offset")
    )
    short = pieces.where(F.col("length") < capacity)
    # Each short piece begins as a bin of its own; its number only has to be unique among the round's items.
    items = written(
        short.select(
            "*",
            F.lit(-1).cast("long").alias("part"),
            F.monotonically_increasing_id().alias("bin"),
            F.lit(0).cast("long").alias("offset"),
        ),
        "packing-items",
    )
    finished = [full.select("doc_id", "piece", "start", "length", "ids_crc32", "part", "bin", "offset")]
    left, number, before = items.count(), 1, None
    parts = max(left // bins_per_task * 4, min(parts_for(pieces), -(-left // LEAF)))
    while left:
        # the last round is one part, or one in which merging no longer helps
        final = parts == 1 or (before is not None and left > 0.9 * before)
        result = written(_round(items, parts, number, capacity, final, slack), f"packing-round{number}")
        finished.append(result.where("done").drop("done"))
        items = result.where(~F.col("done")).drop("done")
        before, left = left, (0 if final else items.select("part", "bin").distinct().count())
        parts = max(1, min(-(-left // bins_per_task), parts // 2))
        number += 1
    packed = finished[0]
    for other in finished[1:]:
        packed = packed.unionByName(other)
    # part tells the round and task, bin the number within: one id of both (2^20 tasks, 2^38 bins each, 32 rounds)
    sequence = F.when(F.col("part") == 0, -1 - F.col("bin")).otherwise(
        F.shiftleft(F.shiftright("part", 32), 58) + F.shiftleft(F.pmod("part", F.lit(1 << 32)), 38) + F.col("bin")
    )
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")


def pack_documents(
    documents: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = SEQUENCE, end: int = END
) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is its ids and ``end``; only longer
    ones are cut, the first piece being the shorter one.

    Defined results: null and empty texts are one piece of one token. Rows with equal ids are separate documents. An empty table gives
    no rows. Other columns are not read.
    """
    ready = token_pieces(documents, tokenizer, id_column, text_column, capacity, end)
    return pack(written(ready, "packing-pieces"), capacity)
