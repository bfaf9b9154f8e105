"""The rule set of the warehouse's tables, and the check that runs it.

Column rules per table as text; a table may also have ranges, allowed row counts per group and conditions between
columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerloom.operators import quality as q, sinks
from layerloom.operators.deltas import Delta
from layerloom.operators.matching import null_safe_join
from layerloom.plans import warehouse
from layerloom.session import scratch_path
from layerloom.sources.tables import read_table, table_exists, table_path


@dataclass(frozen=True)
class TableRules:
    """What must hold for a table. ``parents`` maps a foreign key to "layer.table"; the key has the same name there. ``dated_keys``: the unique keys are hashes
    over the table's partition column too, so equal ones lie in one partition."""

    not_null: str = ""
    unique: str = ""
    dated_keys: bool = False
    parents: Mapping[str, str] = field(default_factory=dict)
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    complete: tuple[Sequence[str], Sequence[int]] | None = None
    holds: Mapping[str, tuple[str, Column]] = field(default_factory=dict)


GRAINS = ["daily", "weekly", "monthly"]
PARTS_OF_DAY = ["Nacht", "Morgen", "Tag", "Abend"]


def _rules() -> dict[str, TableRules]:
    dates = {"date_id": "business_vault.dim_date"}
    times = {**dates, "time_id": "business_vault.dim_time"}
    location = {"location_hk": "business_vault.dim_location"}
    zone = {"price_zone_hk": "business_vault.dim_price_zone"}
    near = F.abs(F.col("apparent_temperature") - F.col("temperature_2m")) <= q.MAX_APPARENT_DEVIATION
    price_summary = TableRules(
        not_null="price_zone_sk price_zone_hk date_id date_key load_date", parents={**zone, **dates}
    )
    return {
        "data_vault.h_location": TableRules(
            not_null="location_hk location_bk load_date record_source", unique="location_hk location_bk"
        ),
        "data_vault.h_price_zone": TableRules(
            not_null="price_zone_hk zone_bk load_date record_source", unique="price_zone_hk zone_bk"
        ),
        "data_vault.s_location_details": TableRules(
            not_null="location_hk location_hashdiff location_key latitude longitude load_date record_source",
            unique="location_hashdiff",
            parents={"location_hk": "data_vault.h_location"},
        ),
        "data_vault.s_weather_hourly": TableRules(
            not_null="location_hk weather_hashdiff measured_at date_key hour load_date record_source",
            unique="weather_hashdiff",
            parents={"location_hk": "data_vault.h_location"},
        ),
        "data_vault.s_energy_price_hourly": TableRules(
            not_null="price_zone_hk price_hashdiff measured_at date_key hour load_date record_source",
            unique="price_hashdiff",
            parents={"price_zone_hk": "data_vault.h_price_zone"},
        ),
        "business_vault.dim_location": TableRules(
            not_null="location_sk location_hk location_key latitude longitude valid_from",
            unique="location_sk location_key",
        ),
        "business_vault.dim_date": TableRules(
            not_null="date_id full_date year quarter month day weekday_num", unique="date_id full_date"
        ),
        "business_vault.dim_time": TableRules(
            not_null="time_id hour minute_of_hour label period", unique="time_id", accepted={"period": PARTS_OF_DAY}
        ),
        "business_vault.dim_price_zone": TableRules(
            not_null="price_zone_sk price_zone_hk bidding_zone valid_from", unique="price_zone_sk bidding_zone"
        ),
        "business_vault.fact_weather_hourly": TableRules(
            not_null="location_sk location_hk date_id time_id measured_at date_key load_date",
            parents={**location, **times},
            ranges={"temperature_2m": q.TEMPERATURE_RANGE, "relative_humidity_2m": q.HUMIDITY_RANGE},
            complete=(["location_hk", "date_key"], q.HOURS_PER_DAY),
            holds={"near_temperature": ("apparent_temperature", near)},
        ),
        "business_vault.fact_weather_daily": TableRules(
            not_null="location_sk location_hk date_id date_key load_date",
            parents={**location, **dates},
            holds={
                "min_not_above_max": ("temperature_min", F.col("temperature_min") <= F.col("temperature_max")),
                "not_negative": ("precipitation_sum", F.col("precipitation_sum") >= 0),
            },
        ),
        "business_vault.fact_energy_price_hourly": TableRules(
            not_null="price_zone_sk price_zone_hk date_id time_id measured_at date_key load_date",
            parents={**zone, **times},
            ranges={"price_eur_mwh": q.PRICE_RANGE},
            complete=(["price_zone_hk", "date_key"], q.PRICE_INTERVALS_PER_DAY),
        ),
        "business_vault.fact_energy_price_daily": price_summary,
        "business_vault.fact_energy_price_monthly": price_summary,
        "marts.weather_trends": TableRules(
            not_null="location_key granularity period_label year", accepted={"granularity": GRAINS}
        ),
        "marts.energy_price_trends": TableRules(
            not_null="bidding_zone granularity period_label year", accepted={"granularity": GRAINS}
        ),
        # The music tables.
        "data_vault.h_track": TableRules(not_null="track_hk track_bk load_date", unique="track_hk track_bk"),
        "data_vault.h_artist": TableRules(not_null="artist_hk artist_bk load_date", unique="artist_hk"),
        "data_vault.h_country": TableRules(not_null="country_hk country_bk load_date", unique="country_hk country_bk"),
        "data_vault.l_track_artist": TableRules(
            not_null="track_artist_hk track_hk artist_hk",
            unique="track_artist_hk",
            parents={"track_hk": "data_vault.h_track", "artist_hk": "data_vault.h_artist"},
        ),
        "data_vault.s_track_details": TableRules(unique="track_hashdiff", parents={"track_hk": "data_vault.h_track"}),
        "data_vault.s_track_audio_features": TableRules(
            unique="audio_hashdiff", parents={"track_hk": "data_vault.h_track"}
        ),
        "data_vault.s_artist_profile": TableRules(
            not_null="artist_hk load_date", parents={"artist_hk": "data_vault.h_artist"}
        ),
        "data_vault.s_chart_entry": TableRules(
            unique="chart_hashdiff", dated_keys=True, parents={"country_hk": "data_vault.h_country"}
        ),
        "business_vault.dim_artist": TableRules(not_null="artist_sk valid_from version_number", unique="artist_sk"),
        "business_vault.dim_track": TableRules(not_null="track_sk track_id", unique="track_sk track_id"),
        "business_vault.dim_country": TableRules(
            not_null="country_sk region_code country_name", unique="country_sk region_code"
        ),
        "business_vault.fact_chart_entry": TableRules(
            not_null="chart_hashdiff country_sk date_id",
            unique="chart_hashdiff",
            dated_keys=True,
            parents={"country_hk": "business_vault.dim_country", **dates},
        ),
        "marts.artist_chart_performance": TableRules(
            not_null="granularity period_label year", accepted={"granularity": GRAINS}
        ),
    }


def rules_of(df: DataFrame, rules: TableRules, parent: Mapping[str, DataFrame]) -> list[q.RowRule | q.KeyRule | q.GroupRule]:
    found: list[q.RowRule | q.KeyRule | q.GroupRule] = [q.not_null(column) for column in rules.not_null.split()]
    found += [q.accepted_values(column, values) for column, values in rules.accepted.items()]
    found += [q.in_range(column, *bounds) for column, bounds in rules.ranges.items()]
    found += [q.holds(name, column, condition) for name, (column, condition) in rules.holds.items()]
    found += [q.unique(df, column) for column in rules.unique.split()]
    found += [q.relationship(df, column, parent[table]) for column, table in rules.parents.items()]
    if rules.complete:
        found.append(q.complete(df, *rules.complete))
    return found


def check(spark: SparkSession, root: str) -> DataFrame:
    """Run every rule on the tables that exist below ``root``: one row per rule with its number of failures."""
    rules = _rules()
    tables = {
        name: read_table(spark, root, *name.split(".")) for name in rules if table_exists(spark, table_path(root, *name.split(".")))
    }
    return q.report({name: (df, rules_of(df, rules[name], tables)) for name, df in tables.items()})


def _partitions() -> dict[str, str]:
    """Tables in partitions, and by what."""
    vault = {f"{warehouse.VAULT}.{name}": model[3][0] for name, model in warehouse.VAULT_MODELS.items() if model[3]}
    return vault | {f"{warehouse.STAR}.{name}": model[-1] for name, model in warehouse.DETAIL_FACTS.items()}


def check_changed(spark: SparkSession, root: str) -> DataFrame:
    """The rows of ``check``, from counts that are kept below ``root`` per rule and partition: of a table in partitions only those that have changed since
    the last check are read. Whole are read: tables that are not in partitions, and the one column of a unique key that is no hash over the partition column, as
equal keys may then lie in two partitions. Counts are kept for a set of rules as it is written; another set starts anew."""
    rules = _rules()
    found = {name: table_path(root, *name.split(".")) for name in rules}
    found = {name: path for name, path in found.items() if table_exists(spark, path)}
    tables = {name: read_table(spark, root, *name.split(".")) for name in found}
    partitions = {name: column for name, column in _partitions().items() if name in tables}
    reports = []
    for name, partition in partitions.items():
        every = rules_of(tables[name], rules[name], tables)
        across = [] if rules[name].dated_keys else [rule for rule in every if rule.name == "unique"]
        wanted = [rule for rule in every if rules[name].dated_keys or rule.name != "unique"]
        book = f"{root}/_checks/{name}/{_fingerprint(rules[name])}"
        delta = Delta(spark, tables[name], found[name], partition, "load_date", f"{book}/read")
        if delta.parts or delta.first:
            changed = delta.rows()
            here = rules_of(changed, rules[name], tables)
            counts = q.counts_of_partitions(changed, partition, [rule for rule in here if rules[name].dated_keys or rule.name != "unique"])
            if not delta.first:
                counts = null_safe_join(spark.read.schema(q.COUNTS).parquet(f"{book}/counts"), delta.changed, ["part"], "left_anti").unionByName(counts)
            staged = scratch_path(spark, "counts")
            counts.write.parquet(staged)
            sinks.overwrite_table(spark.read.schema(q.COUNTS).parquet(staged).coalesce(1), f"{book}/counts")
            sinks.release(spark, staged)
            delta.remember()
        kept = q.kept_failures(spark.read.schema(q.COUNTS).parquet(f"{book}/counts"), wanted)
        kept = kept.unionByName(q.key_failures(across)) if across else kept
        reports.append(kept.select("rule", F.lit(name).alias("table_name"), "column_name", "failures"))
    rest = {name: (df, rules_of(df, rules[name], tables)) for name, df in tables.items() if name not in partitions}
    return reduce(DataFrame.unionByName, [*reports, *([q.report(rest)] if rest else [])])


def _fingerprint(rules: TableRules) -> str:
    return hashlib.md5(repr(rules).encode()).hexdigest()[:12]


def failing(report: DataFrame) -> DataFrame:
    return report.where("failures > 0")
