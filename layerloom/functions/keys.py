"""Hash keys: hub/link keys, hashdiffs and dimension surrogate keys.

The text that goes into a hash is fixed per type, so a key never depends on the session (time zone, locale) or on
how a value happened to be written:

* timestamp without zone: ``yyyy-MM-dd HH:mm:ss.ffffff``, always six fractional digits
* date: ``yyyy-MM-dd``; boolean: ``true`` / ``false``
* everything else: the plain cast to string
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed values (must stay equal, or existing keys no longer match).
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
SK_SEPARATOR = "|"


def canonical_text(column: Column, data_type: T.DataType) -> Column:
    """The one text form of a value that may enter a hash."""
    text = column.cast("string")
    if isinstance(data_type, (T.TimestampNTZType, T.TimestampType)):
        return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))
    return text


def _texts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    types = {field.name: field.dataType for field in df.schema.fields}
    return [canonical_text(F.col(f"`{name}`"), types[name]) for name in columns]


def surrogate_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """md5 over the columns; a NULL takes part as its own token, so (NULL, 'a') and ('a', NULL) differ."""
    parts = [F.coalesce(text, F.lit(NULL_TOKEN)) for text in _texts(df, columns)]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def dimension_sk(df: DataFrame, columns: Sequence[str]) -> Column:
    """md5 over "hk|valid_from"; NULL in, NULL out."""
    texts = _texts(df, columns)
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit(SK_SEPARATOR), text]
    return F.md5(F.concat(*joined))


def with_keys(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add several hash keys in one projection: ``{new_column: [inputs]}``."""
    return df.withColumns({alias: surrogate_key(df, inputs) for alias, inputs in keys.items()})
