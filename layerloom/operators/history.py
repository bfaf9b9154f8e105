"""Ordered history per key: versions, validity intervals, point-in-time lookup.

The plain way is a window per key, which sends all rows of a key to one task. That is right for all keys but hot ones:
keys that hold a large share of the rows. Those are looked for first (one column, counted before the shuffle). If there
are none, the plain window is all that runs. The rows of hot keys take another way to the same result: they are cut
into chunks at quantiles of the order, the window runs inside each chunk, one summary row per chunk is lined up across chunks, and both
are joined. No task then holds more than one chunk of a hot key. Chunks hold about the same number of rows however the key's rows lie in
time, all in one day or over years; only rows of one instant cannot be parted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from layerloom.functions.keys import dimension_sk
from layerloom.operators.matching import null_safe_join
from layerloom.session import scratch_path

# A key with more than this share of all rows is hot. At most 1 / HOT_SHARE keys can be, which bounds the list of hot
# keys (100,000 hash keys, a few MB). Below MIN_HOT_ROWS rows a key is never worth cutting.
HOT_SHARE = 1e-5
MIN_HOT_ROWS = 1_000_000

# The hash join of point_in_time_join compares a fact with all versions of its key, so it is for keys with few.
MAX_COMPARED_VERSIONS = 200
# Versions that are sent to every task, at most.
MAX_SENT_VERSIONS = 100_000
# Hashes of repeated keys that are sent to every task, at most (8 bytes each).
MAX_SENT_HASHES = 500_000

CHUNK = "_chunk"
# Chunks of a hot key, and bounds of all hot keys together, which are sent to every task (a few MB); with very many hot keys each gets fewer, never below the least.
CHUNKS, LEAST_CHUNKS = 1024, 16
MAX_BOUNDS = 1_000_000
# Bounds are looked up in two steps, among every so many of them and then in between.
STEP = 32


@dataclass(frozen=True)
class HotKeys:
    """The hot keys as a small local frame (None: there are none). Their rows are cut at quantiles, or by a unit of time if ``grain`` names one."""

    frame: DataFrame | None = None
    grain: str | None = None


def hot_key_counts(df: DataFrame, keys: Sequence[str], share: float, min_rows: int) -> DataFrame:
    """Keys with more than ``share`` of the rows and more than ``min_rows`` rows; at most 1/share of them.

    Rows are counted before the shuffle, so a hot key costs one row per task here.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_total")).scalar()
    return counts.where((F.col("_rows") > F.lit(share) * total) & (F.col("_rows") > min_rows)).select(*keys)


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    *,
    share: float = HOT_SHARE,
    min_rows: int = MIN_HOT_ROWS,
    grain: str | None = None,
) -> HotKeys:
    """Look for hot keys now. The list that comes back to the driver has at most 1/share rows, whatever the data.

    Ask the stored table that a frame was derived from, not the derived frame: this runs a job over its key columns.
    """
    found = hot_key_counts(df.select(*keys), keys, share, min_rows)
    rows = found.collect()
    return HotKeys(df.sparkSession.createDataFrame(rows, found.schema) if rows else None, grain)


def split_by_heat(df: DataFrame, keys: Sequence[str], hot: HotKeys) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of hot keys if there are any. The broadcast list is bounded, see HotKeys."""
    if hot.frame is None:
        return df, None
    # NULL is a key like any other here, as it is in a window
    return tuple(null_safe_join(df, hot.frame, keys, how, few=True) for how in ("left_anti", "left_semi"))


def quantile_bounds(df: DataFrame, keys: Sequence[str], order: str, chunks: int) -> DataFrame:
    """Where the rows of each key are cut: ``_bounds`` at the quantiles of the order, ``_starts`` every STEP-th of them.

    Approximate quantiles are merged from partial ones, so no task sees all rows of a key. The bounds (``chunks`` per key at most) are held as a
    local frame: every plan made from it, and every task run again, cuts alike.
    """
    fractions = [i / chunks for i in range(1, chunks)]
    found = df.where(F.col(order).isNotNull()).groupBy(*keys).agg(F.percentile_approx(order, fractions, 10 * chunks).alias("_bounds"))
    found = found.withColumn("_bounds", F.array_sort(F.array_distinct("_bounds")))
    rows = [(*row, row["_bounds"][::STEP]) for row in found.collect()]
    bounds = found.schema["_bounds"]
    return df.sparkSession.createDataFrame(rows, T.StructType([*found.schema.fields, T.StructField("_starts", bounds.dataType)]))


def chunked(df: DataFrame, keys: Sequence[str], order: str, hot: HotKeys) -> DataFrame:
    """Rows of hot keys with the number (or start) of their chunk, which rises with the order.

    Rows with a NULL order are a chunk of their own before all others, as a window sorts them. At quantiles: runs a job over the order of these rows.
    """
    if hot.grain is not None:
        start = F.date_trunc(hot.grain, F.col(order)).cast("timestamp_ntz")
        return df.withColumn(CHUNK, F.coalesce(start, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")))
    chunks = max(LEAST_CHUNKS, min(CHUNKS, MAX_BOUNDS // hot.frame.count()))
    marked = null_safe_join(df, quantile_bounds(df.select(*keys, order), keys, order, chunks), keys, "left", few=True)
    block = F.size(F.filter("_starts", lambda bound: bound <= F.col(order)))
    inside = F.slice("_bounds", F.greatest((F.col("_block") - 1) * STEP, F.lit(0)) + 1, STEP)
    place = (F.col("_block") - 1) * STEP + F.size(F.filter(inside, lambda bound: bound <= F.col(order)))
    number = F.when(F.col(order).isNull(), -1).when(F.col("_block") == 0, 0).otherwise(place)
    return marked.withColumn("_block", block).select(*df.columns, number.alias(CHUNK))


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    position: str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """lag / lead / row_number per key in the order of a column, safe for hot keys.

    ``previous`` and ``following`` map new columns to the columns they take from the row before and after;
    ``position`` names the row number. ``order`` must be unique within a key.
    """
    hot = find_hot_keys(df, keys) if hot is None else hot
    wanted = (dict(previous or {}), dict(following or {}), position)
    cold_rows, hot_rows = split_by_heat(df, keys, hot)
    result = _in_one_window(cold_rows, keys, order, *wanted)
    if hot_rows is None:
        return result
    return result.unionByName(_in_chunks(hot_rows, keys, order, hot, *wanted))


def _in_one_window(df, keys, order, previous, following, position) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(order)
    columns = {alias: F.lag(name).over(window) for alias, name in previous.items()}
    columns |= {alias: F.lead(name).over(window) for alias, name in following.items()}
    if position:
        columns[position] = F.row_number().over(window)
    return df.withColumns(columns)


def _in_chunks(df, keys, order, hot, previous, following, position) -> DataFrame:
    cut = chunked(df, keys, order, hot)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order)
    local = cut.withColumns(
        {
            **{f"_p_{alias}": F.lag(name).over(inside) for alias, name in previous.items()},
            **{f"_f_{alias}": F.lead(name).over(inside) for alias, name in following.items()},
            "_place": F.row_number().over(inside),
        }
    )
    # in a struct, because min_by and max_by pass over rows whose order is NULL
    first = F.min_by(F.struct(order, *_distinct(following.values(), order)), F.struct(order))
    last = F.max_by(F.struct(order, *_distinct(previous.values(), order)), F.struct(order))
    ends = cut.groupBy(*keys, CHUNK).agg(F.count("*").alias("_rows"), first.alias("_first"), last.alias("_last"))
    # One row per chunk: a key has at most CHUNKS rows here, or as many as its history has units of time.
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        *keys,
        CHUNK,
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.lag("_last").over(across).alias("_from_before"),
        F.lead("_first").over(across).alias("_from_after"),
    )
    joined = null_safe_join(local, ends, [*keys, CHUNK], "inner")
    at_start, at_end = F.col("_place") == 1, F.col("_place") == F.col("_rows")
    columns = {
        alias: F.when(at_start, F.col(f"_from_before.{name}")).otherwise(F.col(f"_p_{alias}"))
        for alias, name in previous.items()
    }
    columns |= {
        alias: F.when(at_end, F.col(f"_from_after.{name}")).otherwise(F.col(f"_f_{alias}"))
        for alias, name in following.items()
    }
    if position:
        columns[position] = (F.col("_before") + F.col("_place")).cast("int")
    return joined.select(*df.columns, *[column.alias(alias) for alias, column in columns.items()])


def _distinct(names, but: str) -> list[str]:
    return [name for name in dict.fromkeys(names) if name != but]


def one_per(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order, which must be total.

    Spark limits each group before the shuffle, so a key with many copies sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_by)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def one_per_repeated(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str | Column], same: Sequence[str] | None = None) -> DataFrame:
    """As one_per, for keys that hardly ever repeat: hashes of the keys are counted first, now and on their own, and only the rows of hashes that repeat
    are ranked, so the rows as such are neither sorted nor shuffled. ``same``: columns in which copies agree, if these are more than the keys.

    Keys that share a hash by chance are ranked too, each on its own. The repeated hashes are stored; up to MAX_SENT_HASHES are sent to every task,
    more are joined by a shuffle."""
    spark, own = df.sparkSession, F.xxhash64(*keys).alias("_hash")
    found = df.select(own).groupBy("_hash").agg(F.count("*").alias("_copies")).where("_copies > 1").select("_hash")
    path = scratch_path(spark, "repeated-keys")
    found.write.parquet(path)
    repeated = spark.read.schema(found.schema).parquet(path)
    number = repeated.count()
    if number == 0:
        return df
    marks = F.broadcast(repeated) if number <= MAX_SENT_HASHES else repeated
    hashed = df.withColumn("_hash", own)
    several = one_per(hashed.join(marks, "_hash", "left_semi").drop("_hash"), list(same or keys), newest_by)
    return hashed.join(marks, "_hash", "left_anti").drop("_hash").unionByName(several)


def latest_per_key(df: DataFrame, keys: Sequence[str], load: str, tiebreak: Sequence[str]) -> DataFrame:
    """The most recently loaded row of each key; equal load times are decided by the tiebreak columns."""
    return one_per(df, keys, [F.desc(load), *[F.desc(name) for name in tiebreak]])


def changes_only(
    df: DataFrame, keys: Sequence[str], load: str, hashdiff: str, *, hot: HotKeys | None = None
) -> DataFrame:
    """Rows whose hashdiff differs from the row before of the same key.

    Snapshots A, A, B, A give A, B, A: a value that returns is a new version. Rows of one key with the same load time
    are reduced to one first (highest hashdiff), because versions need distinct start times.
    """
    hot = find_hot_keys(df, keys) if hot is None else hot
    wanted = ({"_before_hash": hashdiff}, {}, None)

    def reduced(rows: DataFrame) -> DataFrame:
        return one_per(rows, [*keys, load], [F.desc(hashdiff)])

    cold_rows, hot_rows = split_by_heat(df, keys, hot)
    # Brought together by key at once, both steps (and a with_validity that follows) share one shuffle and one sort.
    compared = _in_one_window(reduced(cold_rows.repartition(*keys)), keys, load, *wanted)
    if hot_rows is not None:
        compared = compared.unionByName(_in_chunks(reduced(hot_rows), keys, load, hot, *wanted))
    return compared.where(~F.col("_before_hash").eqNullSafe(F.col(hashdiff))).drop("_before_hash")


def with_validity(
    versions: DataFrame,
    keys: Sequence[str],
    load: str,
    *,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    version_number: str = "version_number",
    is_current: str = "is_current",
    hot: HotKeys | None = None,
) -> DataFrame:
    """valid_from, valid_to (start of the next version), running version number and the current flag."""
    dated = neighbours(versions, keys, load, following={valid_to: load}, position=version_number, hot=hot)
    return dated.withColumnRenamed(load, valid_from).withColumn(is_current, F.col(valid_to).isNull())


def with_dimension_sk(df: DataFrame, sk: str, hk: str, valid_from: str = "valid_from") -> DataFrame:
    """Put the surrogate key of (hk, valid_from) in front."""
    return df.select(dimension_sk(df, [hk, valid_from]).alias(sk), "*")


def clipped(versions: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str, *, hot: HotKeys | None = None) -> DataFrame:
    """Versions that follow one another: each ends, at the latest, where the next of its key begins. Versions without a key or a beginning are
    no versions; of those that begin together the one that ends last counts (an open end is the last)."""
    known = versions.where(F.col(valid_from).isNotNull()).dropna(subset=list(keys))
    single = one_per(known, [*keys, valid_from], [F.col(valid_to).desc_nulls_first(), *_others(known, keys, valid_from, valid_to)])
    cut = neighbours(single, keys, valid_from, following={"_next_from": valid_from}, hot=hot)
    return cut.withColumn(valid_to, F.least(valid_to, "_next_from")).drop("_next_from")


def _others(df: DataFrame, keys: Sequence[str], *but: str) -> list[str]:
    return [name for name in df.columns if name not in (*keys, *but)]


def point_in_time_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    *,
    attributes: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Each fact with the attributes of the version that was valid at its time, the last one begun if several were; facts without one, or without a key
    or a time, are dropped.

    Two plans over the same clipped versions, so a fact meets one version in either. Few versions, and few per key: a hash join on the key with the
    interval as a residual condition, the facts are not shuffled. Otherwise facts and versions are lined up per key in
    time order and the last version before each fact is carried forward, which compares no pairs and cuts hot keys
    into chunks.
    """
    wanted = versions.select(*dict.fromkeys([*keys, *attributes, valid_from, valid_to]))
    join = interval_join if _few(wanted, keys) else carry_forward_join
    return join(facts, wanted, keys, at, attributes=attributes, valid_from=valid_from, valid_to=valid_to, hot=hot)


def _few(versions: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the versions can be sent to every task and a key's versions be compared one by one; counted, not estimated."""
    if versions.limit(MAX_SENT_VERSIONS + 1).count() > MAX_SENT_VERSIONS:
        return False
    counts = versions.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > MAX_COMPARED_VERSIONS).isEmpty()


def interval_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    *,
    attributes: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot: HotKeys | None = None,
) -> DataFrame:
    """The few-versions plan of point_in_time_join."""
    side = clipped(versions, keys, valid_from, valid_to, hot=hot).select(
        *[F.col(key).alias(f"_v_{key}") for key in keys],
        *attributes,
        F.col(valid_from).alias("_v_from"),
        F.col(valid_to).alias("_v_to"),
    )
    condition = (F.col(at) >= F.col("_v_from")) & (F.col("_v_to").isNull() | (F.col(at) < F.col("_v_to")))
    for key in keys:
        condition &= F.col(key) == F.col(f"_v_{key}")
    return facts.join(F.broadcast(side), condition).select(*facts.columns, *attributes)


def carry_forward_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    *,
    attributes: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot: HotKeys | None = None,
) -> DataFrame:
    """The large-versions plan of point_in_time_join: linear in facts plus versions."""
    keys = list(keys)
    # a key is hot by its facts and versions together
    every = facts.select(*keys).unionByName(versions.select(*keys))
    hot = find_hot_keys(every, keys) if hot is None else hot
    facts = facts.where(F.col(at).isNotNull()).dropna(subset=keys)
    versions = clipped(versions, keys, valid_from, valid_to, hot=hot)
    version = F.struct(*attributes, F.col(valid_to).alias("_v_to"))
    lined_up = facts.select(
        *keys, F.col(at).alias("_at"), F.struct(*facts.columns).alias("_fact"), F.lit(None).alias("_version")
    ).unionByName(
        versions.select(
            *keys, F.col(valid_from).alias("_at"), F.lit(None).alias("_fact"), version.alias("_version")
        )
    )
    cold_rows, hot_rows = split_by_heat(lined_up, keys, hot)
    found = cold_rows.withColumn("_version", F.last("_version", ignorenulls=True).over(_up_to_here(keys)))
    if hot_rows is not None:
        found = found.unionByName(_carried_in_chunks(hot_rows, keys, hot))
    valid = F.col("_version._v_to").isNull() | (F.col("_at") < F.col("_version._v_to"))
    found = found.where(F.col("_fact").isNotNull() & F.col("_version").isNotNull()).where(valid)
    return found.select(
        *[F.col(f"_fact.{name}").alias(name) for name in facts.columns],
        *[F.col(f"_version.{name}").alias(name) for name in attributes],
    )


def _up_to_here(keys: Sequence[str]):
    # A version comes before the facts of its own instant: it is valid from then on.
    window = Window.partitionBy(*keys).orderBy("_at", F.col("_version").isNull())
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _carried_in_chunks(lined_up: DataFrame, keys: Sequence[str], hot: HotKeys) -> DataFrame:
    cut = chunked(lined_up, keys, "_at", hot)
    here = F.last("_version", ignorenulls=True).over(_up_to_here([*keys, CHUNK]))
    local = cut.withColumn("_here", here)
    versioned = F.when(F.col("_version").isNotNull(), F.col("_at"))
    ends = cut.groupBy(*keys, CHUNK).agg(F.max_by("_version", versioned).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, CHUNK, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    return null_safe_join(local, ends, [*keys, CHUNK], "inner").select(
        *keys, "_at", "_fact", F.coalesce("_here", "_carried").alias("_version")
    )


def current_join(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], *, attributes: Sequence[str], is_current: str = "is_current"
) -> DataFrame:
    """Each fact with the attributes of the version that is current now."""
    return facts.join(versions.where(F.col(is_current)).select(*keys, *attributes), list(keys))
