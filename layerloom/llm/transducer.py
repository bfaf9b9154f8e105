"""Byte-level BPE as a streaming transducer, and its inverse.

Encoding reads bytes left to right. For each position it keeps one token: the last token of the encoding of everything read so far. That
token is the only one that ends there and is compatible with the token kept at its own start; two tokens are compatible if the merge list, applied to
their joined bytes, gives back the two. A token is stable once the chains of all positions that a later token can start at (the longest token's length:
the merge list's sufficient lookahead) run through its end; stable tokens are emitted and forgotten, so memory does not grow with the input.

Decoding maps ids to bytes and bytes to text through an incremental UTF-8 state machine that carries unfinished characters over.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layerloom.llm import pretokens
from layerloom.llm.common import whole_text

PAIRS = 1_000_000
SHORT = 64
# Tokens kept while reading the first HEAD bytes of an input are remembered for this many beginnings.
HEAD = 6
HEADS = 200_000
# Units that a worker remembers, in two generations: the older one is dropped when the newer is full.
UNITS_KNOWN = 800_000


class MergeList:
    """The merges of a tokenizer file, over ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.bytes_of = {i: pretokens.as_bytes(t) for t, i in vocabulary.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        self.rank = {(vocabulary[a], vocabulary[b]): (n, vocabulary[a + b]) for n, (a, b) in enumerate(pairs)}
        self.lookahead = max(map(len, self.id_of))
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        # how each token was made: the merge's number and its two parts; single bytes have number -1
        self.made = dict.fromkeys(self.single, -1)
        self.halves: dict[int, tuple[int, int]] = {}
        for (a, b), (n, new) in self.rank.items():
            self.made.setdefault(new, n)
            self.halves.setdefault(new, (a, b))
        self.known_pairs: dict[int, bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """The merge list applied as it stands: the earliest merge first, leftmost first. For short inputs."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            first, at = min((self.rank.get(pair, (1 << 30, 0))[0], i) for i, pair in enumerate(zip(ids, ids[1:])))
            if first == 1 << 30:
                break
            pair = (ids[at], ids[at + 1])
            new, out, i = self.rank[pair][1], [], 0
            while i < len(ids):
                if tuple(ids[i : i + 2]) == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when joined; left = -1 stands for the start of the input.

        Take back the merges next to the border, the latest first. A pair that then faces the border would have merged across it if its own
        merge comes before the one just taken back (or is the same merge and stands further left).
        """
        if left < 0:
            return True
        key = left << 32 | right
        known = self.known_pairs.get(key)
        if known is None:
            known, a, b, before = True, left, right, 1 << 30
            while True:
                crossing = self.rank.get((a, b))
                if crossing is not None and crossing[0] < before:
                    known = False
                    break
                made_a, made_b = self.made[a], self.made[b]
                if made_a < 0 and made_b < 0:
                    break
                if made_a > made_b:
                    before, a = made_a, self.halves[a][1]
                else:
                    before, b = made_b + 1, self.halves[b][0]
            if len(self.known_pairs) >= PAIRS:
                self.known_pairs.clear()
            self.known_pairs[key] = known
        return known


class Transducer:
    """Feed bytes, get stable ids; ``finish`` gives the rest and starts anew."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.heads: dict[bytes, list[int]] = {}
        self._start()

    def _start(self) -> None:
        self.seen = bytearray()  # bytes since the last emitted token's start
        self.last: list[int] = [-1]  # token kept at each position; position 0 is the end of what was emitted
        self.check_at = 4 * self.merges.lookahead

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        at = 0
        while at < len(data):
            self.seen += data[at : at + 4096]
            at += 4096
            self._read(bytes(self.seen))
            if len(self.last) > self.check_at:
                out += self._stable()
        return out

    def _read(self, seen: bytes) -> None:
        """Find the token kept at every position of ``seen`` that has none yet."""
        find, fits, known = self.merges.id_of.get, self.merges.fits, self.merges.known_pairs.get
        longest, last = self.merges.lookahead, self.last
        for end in range(len(last), len(seen) + 1):
            for start in range(end - 1, max(end - longest, 0) - 1, -1):
                token = find(seen[start:end])
                if token is None:
                    continue
                left = last[start]
                found = known(left << 32 | token)
                if found or found is None and fits(left, token):
                    last.append(token)
                    break

    def whole(self, data: bytes) -> list[int]:
        """Ids of an input that is no longer than the lookahead, so that nothing is stable before its end. The tokens kept at the first
        positions depend on the bytes up to there only; they are remembered."""
        head = data[:HEAD]
        self.last = self.heads.get(head, [-1])[:]
        if len(self.last) == 1:
            self._read(head)
            if len(self.heads) >= HEADS:
                self.heads.clear()
            self.heads[head] = self.last[:]
        self._read(data)
        out = self._chain(len(data), 0)
        self._start()
        return out

    def _chain(self, end: int, stop: int) -> list[int]:
        out = []
        while end > stop:
            out.append(self.last[end])
            end -= len(self.merges.bytes_of[self.last[end]])
        return out[::-1]

    def _stable(self) -> list[int]:
        end = len(self.last) - 1
        live = set(range(max(0, end - self.merges.lookahead + 1), end + 1))
        while len(live) > 1:
            at = max(live)
            live.remove(at)
            live.add(at - len(self.merges.bytes_of[self.last[at]]))
        (meet,) = live
        out = self._chain(meet, 0)
        # the token kept at the meeting point still decides what fits after it
        self.last, self.seen = self.last[meet:], self.seen[meet:]
        self.check_at = max(4 * self.merges.lookahead, 2 * len(self.last))
        return out

    def finish(self) -> list[int]:
        out = self._chain(len(self.last) - 1, 0)
        self._start()
        return out


class Codec:
    """Encodes and decodes whole texts in steps of bounded size; one per worker."""

    def __init__(self, path: str, memory: int = UNITS_KNOWN):
        self.merges, self.tokenizer, self.memory = MergeList(path), pretokens.load(path), memory
        self.transducer = Transducer(self.merges)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.table = self.merges.bytes_of | {i: t.encode() for t, i in self.merges.special.items()}

    def _unit(self, unit: str) -> bytes:
        packed = self.known.get(unit) or self.older.get(unit)
        if packed is None:
            data = unit.encode("utf-8", "surrogatepass")
            short = len(data) <= self.merges.lookahead
            ids = self.transducer.whole(data) if short else self.transducer.feed(data) + self.transducer.finish()
            packed = np.asarray(ids, "<u4").tobytes() if len(ids) > 16 else array("I", ids).tobytes()
        if len(unit) <= SHORT:
            if len(self.known) >= self.memory // 2:
                self.older, self.known = self.known, {}
            self.known[unit] = packed
        return packed

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers, in steps. Strings of special tokens are these tokens."""
        parts = [text]
        for token in self.merges.special:
            parts = [x for p in parts for x in ([p] if p in self.merges.special else _between(p, token))]
        for part in parts:
            if part in self.merges.special:
                yield np.asarray([self.merges.special[part]], "<u4").tobytes()
                continue
            for piece in pretokens.pieces(part):
                units = pretokens.units(piece, self.tokenizer)
                try:
                    yield b"".join(map(self.known.__getitem__, units))
                except KeyError:
                    get = self.known.get
                    yield b"".join([get(u) or self._unit(u) for u in units])

    def decode(self, steps: Iterator[bytes]) -> Iterator[str]:
        """Text of ids given in steps; bytes that are no UTF-8 become U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for step in steps:
            yield machine.decode(b"".join(map(self.table.__getitem__, np.frombuffer(step, "<u4").tolist())))
        yield machine.decode(b"", True)


def _between(text: str, token: str) -> list[str]:
    parts = text.split(token)
    out = [x for p in parts[:-1] for x in (p, token)] + parts[-1:]
    return [p for p in out if p]


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(documents: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row; null text is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(tokenizer)
        for batch in batches:
            ids = [np.frombuffer(b"".join(own.encode(t)), "<u4").astype(np.int32) for t in batch.text]
            yield pd.DataFrame({"doc_id": batch.doc_id.astype("Int64"), "ids": ids})

    return _texts(documents, id_column, text_column).mapInPandas(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids are none."""
    empty = F.array().cast("array<int>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(tokenizer)
        for batch in batches:
            texts = ["".join(own.decode(iter([np.asarray(i, "<u4").tobytes()]))) for i in batch.ids]
            yield pd.DataFrame({"doc_id": batch.doc_id.astype("Int64"), "text": texts})

    rows = encoded.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(ids_column), empty).alias("ids"))
    return rows.mapInPandas(run, "doc_id long, text string")


def round_trip(documents: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode and decode every text step by step: doc_id, n_tokens, ids_sha256, decoded_sha256. No text's ids are held as a whole.

    Defined results: null text is empty and has no ids. Rows with equal ids are separate documents. An empty table gives no rows. Other
    columns are not read.
    """

    def digest(own: Codec, text: str) -> tuple[int, str, str]:
        ids, decoded, count = hashlib.sha256(), hashlib.sha256(), 0

        def counted() -> Iterator[bytes]:
            nonlocal count
            for step in own.encode(text):
                ids.update(step)
                count += len(step) // 4
                yield step

        for part in own.decode(counted()):
            decoded.update(part.encode())
        return count, ids.hexdigest(), decoded.hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(tokenizer)
        for batch in batches:
            rows = [digest(own, t) for t in batch.text]
            found = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield found.assign(doc_id=batch.doc_id.astype("Int64").to_numpy())

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string, doc_id long"
    found = _texts(documents, id_column, text_column).mapInPandas(run, schema)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def _texts(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return documents.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
