"""Dimensions built from hubs and satellites: current state, hub only, joined satellites, versioned."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from layerloom.operators.history import (
    HotKeys,
    changes_only,
    find_hot_keys,
    latest_per_key,
    with_dimension_sk,
    with_validity,
)

# Display names of the region codes; any other code is shown in upper case.
COUNTRY_NAMES = {
    "global": "Global",
    "de": "Deutschland",
    "at": "Österreich",
    "ch": "Schweiz",
    "us": "United States",
    "gb": "United Kingdom",
    "fr": "Frankreich",
    "es": "Spanien",
    "it": "Italien",
    "nl": "Niederlande",
    "be": "Belgien",
    "se": "Schweden",
    "no": "Norwegen",
    "dk": "Dänemark",
    "fi": "Finnland",
    "pl": "Polen",
    "pt": "Portugal",
    "br": "Brasilien",
    "mx": "Mexiko",
    "ar": "Argentinien",
    "co": "Kolumbien",
    "cl": "Chile",
    "jp": "Japan",
    "kr": "Südkorea",
    "au": "Australien",
    "nz": "Neuseeland",
    "in": "Indien",
    "ca": "Kanada",
    "ie": "Irland",
    "za": "Südafrika",
    "tr": "Türkei",
    "ru": "Russland",
    "ph": "Philippinen",
    "id": "Indonesien",
    "th": "Thailand",
    "tw": "Taiwan",
    "hk": "Hongkong",
    "sg": "Singapur",
    "my": "Malaysia",
}


def hub_dimension(hub: DataFrame, sk: str, hk: str, bk: str, alias: str) -> DataFrame:
    """A dimension that needs nothing but its hub: key, business key and first load."""
    rows = hub.select(hk, F.col(bk).alias(alias), F.col("load_date").alias("valid_from"))
    return with_dimension_sk(rows, sk, hk)


def lookup_dimension(
    hub: DataFrame, sk: str, hk: str, bk: str, alias: str, name: str, names: Mapping[str, str] = COUNTRY_NAMES
) -> DataFrame:
    """A hub dimension with a display name from a code table; unknown codes are shown in upper case."""
    pairs = [F.lit(text) for pair in names.items() for text in pair]
    display = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(alias)), F.upper(alias))
    rows = hub_dimension(hub, sk, hk, bk, alias)
    return rows.select(sk, hk, alias, display.alias(name), "valid_from")


def current_dimension(
    hub: DataFrame, satellite: DataFrame, sk: str, hk: str, bk: str, alias: str, hashdiff: str, attributes: Sequence[str]
) -> DataFrame:
    """The latest state of each entity.

    The satellite is reduced to its latest row per key before the join, so the join sees one row per key on both
    sides. Equal load times are decided by the hashdiff. Both sides grow with the entities, so the join is by merging, whatever size Spark guesses:
    neither is sent to every task through the driver.
    """
    latest = latest_per_key(satellite.select(hk, hashdiff, "load_date", *attributes), [hk], "load_date", [hashdiff])
    rows = hub.select(hk, F.col(bk).alias(alias)).join(latest.hint("merge"), hk)
    return with_dimension_sk(rows.select(hk, alias, *attributes, F.col("load_date").alias("valid_from")), sk, hk)


def current_dimension_with_extra(
    hub: DataFrame,
    satellite: DataFrame,
    extra: DataFrame,
    sk: str,
    hk: str,
    bk: str,
    alias: str,
    *,
    hashdiff: str,
    attributes: Sequence[str],
    extra_hashdiff: str,
    extra_attributes: Sequence[str],
) -> DataFrame:
    """current_dimension plus the latest row of a second satellite, where there is one (left join)."""
    rows = current_dimension(hub, satellite, sk, hk, bk, alias, hashdiff, attributes)
    side = latest_per_key(
        extra.select(hk, extra_hashdiff, "load_date", *extra_attributes), [hk], "load_date", [extra_hashdiff]
    ).select(hk, *extra_attributes)
    return rows.join(side.hint("merge"), hk, "left").select(sk, hk, alias, *attributes, *extra_attributes, "valid_from")


def versioned_dimension(
    hub: DataFrame,
    satellite: DataFrame,
    sk: str,
    hk: str,
    bk: str,
    hashdiff: str,
    attributes: Sequence[str],
    *,
    hot: HotKeys | None = None,
) -> DataFrame:
    """SCD2: every version of an entity with validity interval, version number, current flag and its own key.

    Rows that repeat the state before them are merged and one row is kept per load time, so no version has zero
    length. Versions join their hub last, when each is final; a hub grows with its entities and is not sent to every task.
    """
    history = satellite.select(hk, hashdiff, *attributes, "load_date")
    hot = find_hot_keys(satellite, [hk]) if hot is None else hot
    versions = changes_only(history, [hk], "load_date", hashdiff, hot=hot)
    dated = with_validity(versions, [hk], "load_date", hot=hot)
    rows = dated.join(hub.select(hk, bk).hint("merge"), hk)
    rows = with_dimension_sk(rows, sk, hk)
    return rows.select(sk, hk, bk, *attributes, "valid_from", "valid_to", "version_number", "is_current")
