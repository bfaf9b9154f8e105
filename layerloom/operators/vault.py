"""Insert-only loads of hubs, links and satellites.

Each function returns the rows to append: the new state of the staging rows minus what the target already holds.
Grouping with an aggregate comes first (partial aggregation before the shuffle, so copies of one key collapse in the
task that read them) and leaves one row per key, so the anti join that follows sees no skew from the batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from layerloom.functions.keys import with_keys
from layerloom.operators.history import HotKeys, changes_only, find_hot_keys, one_per_repeated
from layerloom.operators.matching import null_safe_join
from layerloom.operators.sinks import new_rows
from layerloom.session import scratch_path

LOADED = "_loaded_at"


def _not_loaded(rows: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    return rows if target is None else new_rows(rows, target, keys)


def load_hub(
    staging: DataFrame, hk: str, bk: str, alias: str, record_source: str, target: DataFrame | None = None
) -> DataFrame:
    """One row per business key with its first load time, if the hub does not know the key yet.

    The hash key is a function of the business key, so it is taken of the grouped keys, not of every staging row.
    """
    rows = staging.groupBy(F.col(bk).alias(alias)).agg(F.min(LOADED).alias("load_date"))
    rows = with_keys(rows, {hk: [alias]}).select(hk, alias, "load_date", F.lit(record_source).alias("record_source"))
    return _not_loaded(rows, target, [hk])


def load_shared_hub(
    sources: Sequence[tuple[DataFrame, Sequence[str], str, str]],
    hk: str,
    alias: str,
    preferred: str,
    target: DataFrame | None = None,
) -> DataFrame:
    """A hub fed by several sources ``(staging, key inputs, business key column, record source)``.

    Per hash key: the preferred source's business key (the greatest), else the smallest of the others; the first load;
    the greatest source name. Each source is grouped and hashed first, so text is only compared between distinct keys.
    """
    combined = None
    for staging, inputs, bk, record_source in sources:
        rows = staging.groupBy(*dict.fromkeys([*inputs, bk])).agg(F.min(LOADED).alias("load_date"))
        rows = with_keys(rows, {hk: inputs}).select(
            hk, F.col(bk).alias(alias), "load_date", F.lit(record_source).alias("record_source")
        )
        combined = rows if combined is None else combined.unionByName(rows)
    from_preferred = F.when(F.col("record_source") == preferred, F.col(alias))
    merged = combined.groupBy(hk).agg(
        F.coalesce(F.max(from_preferred), F.min(alias)).alias(alias),
        F.min("load_date").alias("load_date"),
        F.max("record_source").alias("record_source"),
    )
    return _not_loaded(merged, target, [hk])


def load_link(
    staging: DataFrame,
    link_hk: str,
    parts: Sequence[str],
    hks: Mapping[str, Sequence[str]],
    record_source: str,
    target: DataFrame | None = None,
) -> DataFrame:
    """One row per combination of business keys: the link's key over all ``parts``, and the hub keys in ``hks`` over
    the parts they are made of. Hashed after grouping, as in load_hub."""
    rows = staging.groupBy(*parts).agg(F.min(LOADED).alias("load_date"))
    rows = with_keys(rows, {link_hk: parts, **hks}).select(
        link_hk, *hks, "load_date", F.lit(record_source).alias("record_source")
    )
    return _not_loaded(rows, target, [link_hk])


def load_state_satellite(
    staging: DataFrame,
    hk: str,
    hashdiff: str,
    keys: Mapping[str, Sequence[str]],
    attributes: Sequence[str],
    record_source: str,
    target: DataFrame | None = None,
) -> DataFrame:
    """Distinct states of an entity with their first load time, if the hashdiff is not known yet.

    ``keys`` says which columns ``hk`` and ``hashdiff`` are made of. Hashed after grouping, as in load_hub.
    """
    grain = dict.fromkeys([*keys[hk], *keys[hashdiff], *attributes])
    rows = staging.groupBy(*grain).agg(F.min(LOADED).alias("load_date"))
    rows = with_keys(rows, {hk: keys[hk], hashdiff: keys[hashdiff]}).select(
        hk, hashdiff, *attributes, "load_date", F.lit(record_source).alias("record_source")
    )
    return _not_loaded(rows, target, [hashdiff])


def _satellite_rows(staging: DataFrame, columns: Sequence[str]) -> DataFrame:
    return staging.select(*columns, "_source_file", F.col(LOADED).alias("load_date"), "record_source")


def _stored(rows: DataFrame) -> DataFrame:
    path = scratch_path(rows.sparkSession, "satellite-rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def load_event_satellite(
    staging: DataFrame, columns: Sequence[str], hashdiff: str, target: DataFrame | None = None, *, whole_rows: bool = False
) -> DataFrame:
    """Readings or entries; rows whose hashdiff the target holds are left out, with ``whole_rows`` rows that it holds in every column.

    Of copies inside the batch the first loaded one is kept (ties by source file, then by the columns). Copies are rows of one hashdiff;
    with ``whole_rows`` only rows equal in every column are, and entries that differ in any of them all stay.

    Hardly any row is a copy, so the rows are not sorted to find them: hashdiffs are counted first, on their own, and
    only the rows of those that repeat are ranked. The batch's rows are stored first, so they are joined and hashed once.
    """
    rows = _stored(_satellite_rows(staging, columns))
    same = [*columns, "record_source"] if whole_rows else [hashdiff]
    rest = [name for name in rows.columns if name not in (*same, "load_date", "_source_file")]
    kept = one_per_repeated(rows, [hashdiff], ["load_date", "_source_file", *rest], same)
    if whole_rows and target is not None:
        return null_safe_join(kept, target.select(*same), same, "left_anti")
    return _not_loaded(kept, target, [hashdiff])


def load_correctable_satellite(
    staging: DataFrame, key: Sequence[str], columns: Sequence[str], hashdiff: str, target: DataFrame | None = None
) -> DataFrame:
    """Readings of which every change is kept; ``hashdiff`` covers the key and the measures.

    A key's rows of batch and target are lined up by load time (ties: the smallest hashdiff is the newest, as in the facts), and a row is
    inserted if it differs from the one before, so a value that is corrected and corrected back (A, B, A) is three rows. The newest row of the
    batch is what the raw layer says now. If the target's newest row says the same, nothing is inserted for it; if that row is not older (a
    slice was loaded again with the same load time or an earlier one), the batch's row gets a load time one microsecond after it.

    Copies collapse before the window; what is left of a key is one row per value and load time.
    """
    rows = _satellite_rows(staging, columns)
    same = [hashdiff, "load_date"]
    rest = [name for name in rows.columns if name not in (*same, "_source_file")]
    lined_up = one_per_repeated(rows, same, ["_source_file", *rest]).withColumn("_new", F.lit(True))
    if target is not None:
        stored = target.join(lined_up.select(*key).distinct(), list(key), "left_semi")
        lined_up = lined_up.unionByName(stored.select(*rows.columns).withColumn("_new", F.lit(False)))
    repeated = lined_up.groupBy(*key).agg(F.count("*").alias("_rows")).where("_rows > 1").select(*key)
    in_order = Window.partitionBy(*key).orderBy("load_date", F.desc(hashdiff), "_new")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.struct("load_date", hashdiff)
    compared = lined_up.join(repeated, list(key), "left_semi").select(
        *rows.columns,
        "_new",
        F.lag(hashdiff).over(in_order).alias("_before"),
        F.last("_new").over(whole).alias("_ahead"),  # the newest row of all is the batch's
        F.last(F.when(F.col("_new"), place), ignorenulls=True).over(whole).alias("_wanted"),
        F.last(F.when(~F.col("_new"), place), ignorenulls=True).over(whole).alias("_stored"),
    )
    is_wanted = F.col("_wanted") == place
    agreed = F.coalesce(F.col(f"_wanted.{hashdiff}") == F.col(f"_stored.{hashdiff}"), F.lit(False))
    behind = is_wanted & ~agreed & ~F.col("_ahead")
    changed = ~F.col("_before").eqNullSafe(F.col(hashdiff)) & ~(is_wanted & agreed)
    load_date = F.when(behind, F.col("_stored.load_date") + F.expr("interval 1 microsecond")).otherwise(F.col("load_date"))
    several = compared.where(F.col("_new") & (behind | changed)).withColumn("load_date", load_date)
    once = lined_up.join(repeated, list(key), "left_anti").where("_new")
    return once.select(*rows.columns).unionByName(several.select(*rows.columns))


def load_version_satellite(
    staging: DataFrame,
    hk: str,
    columns: Sequence[str],
    hashdiff: str,
    target: DataFrame | None = None,
    *,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Versions of an entity: a row is inserted when its hashdiff differs from the version before it.

    The batch is lined up with the target's rows of the touched keys, so a value that returns to an old state (A, B, A)
    is a new version, and a late snapshot finds its place in the past. Load the batch again and nothing is new: its
    rows are in the target already and are left out.
    """
    batch = _satellite_rows(staging, columns)
    if hot is None:  # a key is hot by its history, of which a batch shows little
        hot = find_hot_keys(batch.select(hk) if target is None else batch.select(hk).unionByName(target.select(hk)), [hk])
    if target is None:
        return changes_only(batch, [hk], "load_date", hashdiff, hot=hot)
    known = target.select(hk, "load_date").distinct()
    fresh = batch.join(known, [hk, "load_date"], "left_anti")
    touched = fresh.select(hk).distinct()
    earlier = target.join(touched, [hk], "left_semi")
    lined_up = fresh.withColumn("_new", F.lit(True)).unionByName(earlier.withColumn("_new", F.lit(False)))
    return changes_only(lined_up, [hk], "load_date", hashdiff, hot=hot).where("_new").drop("_new")


def load_unseen_satellite(
    staging: DataFrame, columns: Sequence[str], hashdiff: str, target: DataFrame | None = None
) -> DataFrame:
    """The literal insert rule: every staging row whose hashdiff the target has never held, copies included."""
    return _not_loaded(_satellite_rows(staging, columns), target, [hashdiff])
