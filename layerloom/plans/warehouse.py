"""The whole warehouse as an ordered list of models, each written to ``{root}/{layer}/{table}``.

Staging is never stored. Hubs, links and satellites are appended to, from the raw partitions that changed since they last read them. Dimensions
and marts are rebuilt. Facts are loaded in slices: the days of which the satellite changed are written anew from it, the newest reading of each
key, so late rows, corrections and repeated runs end in the same table as a build from scratch (a moved location's surrogate key aside: days that did not
change keep the one they were loaded with; nothing is grouped or joined by it).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerloom.operators import facts, sinks, staging
from layerloom.operators.calendar import FIRST_DAY, LAST_DAY, dim_date, dim_time
from layerloom.operators.deltas import NAMED, Delta
from layerloom.operators.history import one_per_repeated
from layerloom.plans import domains
from layerloom.sources.schemas import RAW_PARTITIONS
from layerloom.sources.tables import read_table, table_exists, table_path

VAULT, STAR, MARTS = "data_vault", "business_vault", "marts"


@dataclass(frozen=True)
class Run:
    """One build: where the tables are, the day the relative columns refer to, and whether all is built anew."""

    spark: SparkSession
    root: str
    as_of: str
    full_refresh: bool = False
    correctable: bool = False

    def path(self, layer: str, name: str) -> str:
        return table_path(self.root, layer, name)

    def has(self, layer: str, name: str) -> bool:
        return table_exists(self.spark, self.path(layer, name))

    def read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.root, layer, name)

    def current(self, layer: str, name: str) -> DataFrame | None:
        """The table to add to, if there is one."""
        return None if self.full_refresh or not self.has(layer, name) else self.read(layer, name)

    def delta(self, reader: str, layer: str, name: str, partition: str | None, load: str) -> Delta:
        """What changed in a table since ``reader`` last read it."""
        book = f"{self.root}/_read/{reader}/{name}"
        return Delta(self.spark, self.read(layer, name), self.path(layer, name), partition, load, book, everything=self.current(*self.place(reader)) is None)

    def raw_partition(self, name: str) -> str | None:
        """Tables loaded by file are partitioned by it."""
        return "file_key" if "file_key" in self.read("raw", name).columns else next(iter(RAW_PARTITIONS[name]), None)

    def place(self, name: str) -> tuple[str, str]:
        return (VAULT if name in VAULT_MODELS else STAR), name

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        _, stage = STAGING[name]
        return stage(rows, correctable=True) if self.correctable and name in CORRECTABLE else stage(rows)


STAGING: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "weather": ("weather_hourly", staging.weather),
    "energy_price": ("energy_price_hourly", staging.energy_price),
    "track": ("spotify_tracks", staging.track),
    "chart": ("spotify_charts", staging.chart),
    "artist_snapshot": ("spotify_artist_snapshots", staging.artist_snapshot),
}

# Readings whose corrections can be let through to the facts.
CORRECTABLE = ("weather", "energy_price")
CORRECTABLE_SATELLITES = ("s_weather_hourly", "s_energy_price_hourly")

# name -> (model, staging inputs, unique key of the appended rows, partition columns, column that bounds the target)
VAULT_MODELS: dict[str, tuple[Callable[..., DataFrame], list[str], list[str], list[str], str | None]] = {
    "h_location": (domains.h_location, ["weather"], ["location_hk"], [], None),
    "h_price_zone": (domains.h_price_zone, ["energy_price"], ["price_zone_hk"], [], None),
    "h_track": (domains.h_track, ["track"], ["track_hk"], [], None),
    "h_country": (domains.h_country, ["chart"], ["country_hk"], [], None),
    "h_artist": (domains.h_artist, ["track", "artist_snapshot"], ["artist_hk"], [], None),
    "l_track_artist": (domains.l_track_artist, ["track"], ["track_artist_hk"], [], None),
    "s_location_details": (domains.s_location_details, ["weather"], ["location_hashdiff"], [], None),
    "s_track_details": (domains.s_track_details, ["track"], ["track_hashdiff"], [], None),
    "s_track_audio_features": (domains.s_track_audio_features, ["track"], ["audio_hashdiff"], [], None),
    "s_artist_profile": (domains.s_artist_profile, ["artist_snapshot"], ["artist_hk", "load_date"], [], None),
    "s_weather_hourly": (domains.s_weather_hourly, ["weather"], ["weather_hashdiff"], ["date_key"], "measured_at"),
    "s_energy_price_hourly": (
        domains.s_energy_price_hourly, ["energy_price"], ["price_hashdiff"], ["date_key"], "measured_at",
    ),
    "s_chart_entry": (domains.s_chart_entry, ["chart"], [], ["chart_date"], "chart_date"),
}

# name -> (model, input tables of the vault)
DIMENSIONS: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "dim_location": (domains.dim_location, ["h_location", "s_location_details"]),
    "dim_price_zone": (domains.dim_price_zone, ["h_price_zone"]),
    "dim_country": (domains.dim_country, ["h_country"]),
    "dim_track": (domains.dim_track, ["h_track", "s_track_details", "s_track_audio_features"]),
    "dim_artist": (domains.dim_artist, ["h_artist", "s_artist_profile"]),
}

# name -> (model, satellite, dimension, key of which the newest row counts (none: every row does), partition column)
DETAIL_FACTS: dict[str, tuple[Callable[..., DataFrame], str, str, list[str], str]] = {
    "fact_weather_hourly": (
        domains.fact_weather_hourly, "s_weather_hourly", "dim_location", ["location_hk", "measured_at"], "date_key",
    ),
    "fact_energy_price_hourly": (
        domains.fact_energy_price_hourly, "s_energy_price_hourly", "dim_price_zone",
        ["price_zone_hk", "measured_at"], "date_key",
    ),
    "fact_chart_entry": (
        domains.fact_chart_entry, "s_chart_entry", "dim_country", [], "chart_date",
    ),
}

# name -> (aggregate, source fact, detail fact whose changes count, period of a slice)
AGGREGATE_FACTS: dict[str, tuple[Callable[[DataFrame], DataFrame], str, str, str]] = {
    "fact_weather_daily": (facts.weather_daily, "fact_weather_hourly", "fact_weather_hourly", "day"),
    "fact_energy_price_daily": (facts.energy_price_daily, "fact_energy_price_hourly", "fact_energy_price_hourly", "day"),
    "fact_energy_price_monthly": (facts.energy_price_monthly, "fact_energy_price_daily", "fact_energy_price_hourly", "month"),
}


def load_vault_table(run: Run, name: str) -> None:
    """Append what is new. The columns that bound the target are part of the hashed key, so pruning is exact."""
    model, inputs, key, partition_by, bounded_by = VAULT_MODELS[name]
    if run.correctable and name in CORRECTABLE_SATELLITES:  # a value that returns is a row of its own
        model, key = partial(model, correctable=True), [*key, "load_date"]
    raws = [STAGING[source][0] for source in inputs]
    deltas = [run.delta(name, "raw", raw, run.raw_partition(raw), "_loaded_at") for raw in raws]
    target = run.current(VAULT, name)
    if target is not None and all(delta.empty for delta in deltas):
        return
    stages = [run.stage(source, delta.rows()) for source, delta in zip(inputs, deltas)]
    if target is None:
        sinks.overwrite_table(model(*stages), run.path(VAULT, name), partition_by, record=bool(partition_by))
    else:
        if bounded_by is not None:
            target = sinks.only_between(target, stages[0], bounded_by)
        sinks.append_rows(
            run.spark,
            model(*stages, target=target),
            run.path(VAULT, name),
            unique_key=key,
            partition_by=partition_by,
            check_target=False,  # just anti-joined with it
        )
    for delta in deltas:
        delta.remember()


def days_covered(run: Run) -> tuple[str, str]:
    """The calendar's range, widened to the days of all readings and entries, so that no fact falls outside of it."""
    first, last = FIRST_DAY, LAST_DAY
    for _, satellite, _, _, partition in DETAIL_FACTS.values():
        if run.has(VAULT, satellite):
            low, high = run.read(VAULT, satellite).agg(F.min(partition).cast("string"), F.max(partition).cast("string")).first()
            first, last = min(first, low or first), max(last, high or last)
    return first, last


def build_dimension(run: Run, name: str) -> None:
    model, inputs = DIMENSIONS[name]
    sinks.overwrite_table(model(*[run.read(VAULT, table) for table in inputs]), run.path(STAR, name))


def load_detail_fact(run: Run, name: str) -> None:
    """The days of which the satellite changed, written anew: the newest row of each key, with the key of the dimension."""
    model, satellite, dimension, key, partition = DETAIL_FACTS[name]
    changed = run.delta(name, VAULT, satellite, partition, "load_date")
    if changed.empty and not changed.first:
        return
    rows = changed.rows()
    if key:
        rest = [column for column in rows.columns if column not in (*key, "load_date")]
        rows = one_per_repeated(rows, key, [F.desc("load_date"), *rest])
    rows = model(rows, run.read(STAR, dimension))
    if changed.first:
        sinks.overwrite_table(rows, run.path(STAR, name), [partition], record=True)
    else:
        parts = changed.parts if len(changed.parts) <= NAMED else None
        sinks.replace_partitions(rows, run.path(STAR, name), [partition], parts=parts)
    changed.remember()


def load_aggregate_fact(run: Run, name: str) -> None:
    """The periods in which the detail fact changed are aggregated again as a whole and replaced."""
    aggregate, source, detail, period = AGGREGATE_FACTS[name]
    changed = run.delta(name, STAR, detail, "date_key", "load_date")
    if changed.empty and not changed.first:
        return
    rows = run.read(STAR, source)
    if changed.first:
        sinks.overwrite_table(aggregate(rows), run.path(STAR, name), ["date_key"])
    else:
        if period == "day":
            rows = changed.rows(rows)
        else:
            dated = rows.withColumn("_period", F.trunc("date_key", period))
            touched = changed.changed.select(F.trunc(F.col("part").cast("date"), period).alias("_period"))
            rows = facts.touched_slices(dated, touched, "_period").drop("_period")
        sinks.replace_partitions(aggregate(rows), run.path(STAR, name), ["date_key"])
    changed.remember()


def build_marts(run: Run) -> None:
    calendar = run.read(STAR, "dim_date")
    if run.has(STAR, "fact_weather_daily"):
        mart = domains.weather_trends(
            run.read(STAR, "fact_weather_daily"), calendar, run.read(STAR, "dim_location"), run.as_of
        )
        sinks.overwrite_table(mart, run.path(MARTS, "weather_trends"))
    if run.has(STAR, "fact_energy_price_daily"):
        mart = domains.energy_price_trends(
            run.read(STAR, "fact_energy_price_daily"), calendar, run.read(STAR, "dim_price_zone"), run.as_of
        )
        sinks.overwrite_table(mart, run.path(MARTS, "energy_price_trends"))
    if run.has(STAR, "fact_chart_entry"):
        mart = domains.artist_chart_performance(run.read(STAR, "fact_chart_entry"), calendar)
        sinks.overwrite_table(mart, run.path(MARTS, "artist_chart_performance"))


def build(
    spark: SparkSession, root: str, as_of: str, *, full_refresh: bool = False, correctable: bool = False, threads: int = 4
) -> list[str]:
    """Bring every table up to date with the raw layer, in dependency order; domains without raw data are skipped.

    Tables of one step do not depend on each other and are loaded by a few threads, so small ones do not wait for
    large ones. ``full_refresh`` builds every table from the raw layer, as if none were there. ``correctable``: a reading that is
    loaded again with other measures replaces the old one in the facts; the satellite keeps both. Returns the names of the
    tables that were built.
    """
    run = Run(spark, root, as_of, full_refresh, correctable)
    built: list[str] = []

    def step(names: Sequence[str], ready: Callable[[str], bool], load: Callable[[Run, str], None]) -> None:
        chosen = [name for name in names if ready(name)]
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(lambda name: load(run, name), chosen))
        built.extend(chosen)

    step(
        list(VAULT_MODELS),
        lambda name: all(run.has("raw", STAGING[source][0]) for source in VAULT_MODELS[name][1]),
        load_vault_table,
    )
    sinks.overwrite_table(dim_date(spark, as_of, *days_covered(run)), run.path(STAR, "dim_date"))
    sinks.overwrite_table(dim_time(spark), run.path(STAR, "dim_time"))
    built += ["dim_date", "dim_time"]
    step(
        list(DIMENSIONS),
        lambda name: all(run.has(VAULT, table) for table in DIMENSIONS[name][1]),
        build_dimension,
    )
    step(
        list(DETAIL_FACTS),
        lambda name: run.has(VAULT, DETAIL_FACTS[name][1]) and run.has(STAR, DETAIL_FACTS[name][2]),
        load_detail_fact,
    )
    # The monthly fact reads the daily one.
    for name in AGGREGATE_FACTS:
        step([name], lambda name: run.has(STAR, AGGREGATE_FACTS[name][1]), load_aggregate_fact)
    build_marts(run)
    return built
