"""URL rules through a cascade of Bloom filters: exact membership over the corpus's own keys, without a join.

Level 1 encodes the listed keys, level 2 the keys of the corpus that level 1 takes for listed though they are not, level 3
the listed keys that level 2 takes for such false positives, and so on until a level has nothing to encode. A key of the corpus
is listed if the first level that does not hold it is an even one (levels count from 1). The answer is exact for every key that was part of the
universe the cascade was built over; here that is every (host suffix, path prefix) of every url that is as long as one of some rule: a
suffix with another number of labels, or a prefix of another length, is no rule's, so a very long host costs no more than a short one.

All steps are built-in functions. Each level is a bit array of bounded size (``max_bits``) and goes into the plan as a constant. Keys that need
larger levels, or more of them than ``MAX_LEVELS``, are judged by a shuffled join of the different (host, path) with the rules instead; the rows are the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HASHES = 4
BITS_PER_KEY = 8
MAX_BITS = 1 << 27
MAX_LEVELS = 40


class TooManyKeys(ValueError):
    """The keys do not fit into a cascade of bounded levels."""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``, ``#`` or
    the end. Both empty for null and for text without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({u}, instr({u}, '://') + 3)".format(u="__url")))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _bits(key: Column, level: int, size: int) -> list[Column]:
    """The bit numbers of a key: double hashing from one 64-bit hash salted with the level."""
    mixed = F.xxhash64(key, F.lit(level))
    low, high = mixed.bitwiseAND(0x7FFFFFFF), F.shiftrightunsigned(mixed, 32).bitwiseOR(F.lit(1).cast("bigint"))
    return [F.pmod(low + high * i, F.lit(size)) for i in range(HASHES)]


def _size(n_keys: int) -> int:
    """Bits of a level, a power of two."""
    size = 64
    while size < n_keys * BITS_PER_KEY:
        size *= 2
    return size


@dataclass(frozen=True)
class Level:
    number: int
    size: int
    words: tuple[tuple[int, int], ...]  # word number -> 64 bits; words without a bit are left out

    def holds(self, key: Column) -> Column:
        dense = dict(self.words)
        text = "[" + ",".join(str(dense.get(i, 0)) for i in range(self.size // 64)) + "]"
        words = F.from_json(F.lit(text), "array<bigint>")  # constant, so folded before the rows are read
        tests = [
            F.getbit(F.get(words, F.shiftright(b, 6).cast("int")), F.pmod(b, F.lit(64)).cast("int")) == 1
            for b in _bits(key, self.number, self.size)
        ]
        return reduce(lambda x, y: x & y, tests)


def _level(keys: DataFrame, number: int, max_bits: int) -> Level | None:
    """Encode the column ``key``; the bits are or-ed in Spark, only the finished words reach the driver."""
    n = keys.count()
    if n == 0:
        return None
    size = _size(n)
    if size > max_bits:
        raise TooManyKeys(f"level {number} needs {size} bits for {n} keys; the bound is {max_bits}")
    bit = F.explode(F.array(*_bits(F.col("key"), number, size)))
    words = (
        keys.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    )
    return Level(number, size, tuple(sorted((r.word, r.bits) for r in words.collect())))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Exact for keys of the universe: the number of the first level that rejects decides."""
        if not self.levels:
            return F.lit(False)
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.holds(key), answer).otherwise(F.lit(level.number % 2 == 0))
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS, max_levels: int = MAX_LEVELS) -> Cascade:
    """``listed`` and ``universe``: frames with one column ``key``; repeated and null keys are allowed and do not matter.

    Only the first level sees the whole universe, in one pass without a shuffle; what passes it is a small share.
    """
    listed = listed.where(F.col("key").isNotNull()).distinct()
    levels: list[Level] = []
    first = _level(listed, 1, max_bits)
    if first is None:
        return Cascade(())
    levels.append(first)
    taken = universe.where(F.col("key").isNotNull() & first.holds(F.col("key"))).distinct()
    wrong = taken.join(listed, "key", "left_anti")  # false positives of level 1
    right = listed
    while len(levels) < max_levels:
        number = len(levels) + 1
        level = _level(wrong, number, max_bits)
        if level is None:
            return Cascade(tuple(levels))
        levels.append(level)
        # the other side's keys that this level takes for its own are next
        right, wrong = wrong, right.where(level.holds(F.col("key")))
    raise TooManyKeys(f"no end after {max_levels} levels")


def url_keys(host: Column, path: Column, labels: list[int], prefixes: list[int]) -> Column:
    """Keys of a url: its host's last labels, as many as given, each with the path prefixes of the given lengths. A url that has fewer labels or a shorter
    path has no such key."""
    parts = F.split(host, r"\.")

    def key(n: int, length: int) -> Column:
        suffix = F.array_join(F.slice(parts, -n, n), ".")
        return F.when((F.size(parts) >= n) & (F.length(path) >= length), F.concat(suffix, F.substring(path, 1, length)))

    return F.array_compact(F.array(*[key(n, length) for n in labels for length in prefixes]))


def _judged_by_join(keyed: DataFrame, rules: list[Rule]) -> DataFrame:
    """The best rule by a join on the key; urls of one host and path are one row in it, however many there are."""
    listed = keyed.sparkSession.createDataFrame([(r.text, r.verdict) for r in rules], "key string, verdict string")
    pairs = keyed.select("host", "path", F.explode("keys").alias("key")).distinct()
    best = F.max(F.struct(F.length("key").alias("n"), F.col("key").alias("rule"), "verdict")).alias("best")
    found = pairs.join(listed, "key").groupBy("host", "path").agg(best)
    return keyed.join(found, ["host", "path"], "left")


def _hits(verdict: str, cascade: Cascade) -> Column:
    return F.transform(F.filter("keys", cascade.holds), lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"), F.lit(verdict).alias("verdict")))


def judge_urls(pages: DataFrame, rules: list[Rule], id_column: str = "page_id", url_column: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """(id, host, path, rule, verdict) of every row: the longest rule that fits, else no rule and verdict ``allow``.

    Defined results: null url or no ``://``: empty host and path, no rule. Repeated rows are judged each. An empty table or an empty
    rule list gives no rules. A host may have any number of labels. Other columns are not read. Rules of one key with different verdicts are an error.
    """
    if len({(r.host, r.path) for r in rules}) != len(rules):
        raise ValueError("two rules with the same host and path")
    spark = pages.sparkSession
    base = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    parsed = base.select("page_id", host.alias("host"), path.alias("path"))
    labels, prefixes = sorted({r.host.count(".") + 1 for r in rules}), sorted({len(r.path) for r in rules})
    if not rules:
        return parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    keyed = parsed.withColumn("keys", url_keys(F.col("host"), F.col("path"), labels, prefixes))
    universe = keyed.select(F.explode("keys").alias("key"))
    verdicts = sorted({r.verdict for r in rules})
    listed = {v: spark.createDataFrame([(r.text,) for r in rules if r.verdict == v], "key string") for v in verdicts}
    try:
        cascades = {v: build_cascade(listed[v], universe, max_bits) for v in verdicts}
        best = keyed.withColumn("best", F.array_max(F.concat(*[_hits(v, cascades[v]) for v in verdicts])))
    except TooManyKeys:
        best = _judged_by_join(keyed, rules)
    return best.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict")
    )
