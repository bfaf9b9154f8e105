"""Typing and cleaning of landed text, and rounding that does not depend on the order of a sum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Spellings that count as true, and the texts that stand for NULL in bulk files.
TRUE_WORDS = ("true", "1", "yes")
NULL_TEXTS = ("", "NULL")
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"


def blank_to_null(text: Column) -> Column:
    """Blank text is NULL; other text keeps its blanks."""
    return F.when(F.trim(text) != "", text)


def marker_to_null(text: Column, markers: Sequence[str] = NULL_TEXTS) -> Column:
    """Text equal to one of the markers is NULL (exact match, no trimming)."""
    return F.when(~text.isin(*markers), text)


def safe_double(text: Column) -> Column:
    """Number or NULL. Suffixes such as ``1.5d``, which a plain cast accepts, are not numbers."""
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def safe_long(text: Column) -> Column:
    """Integer through truncation ("3.7" -> 3), NULL when it is no number or does not fit."""
    number = safe_double(text)
    whole = F.when(F.isnan(number), None).otherwise(number).try_cast("bigint")
    # Plain whole numbers skip the detour through double, which would lose digits above 2^53.
    return F.coalesce(F.trim(text).try_cast("bigint"), whole)


def safe_int(text: Column) -> Column:
    return safe_long(text).try_cast("int")


def safe_boolean(text: Column) -> Column:
    """Blank -> NULL; true for one of TRUE_WORDS in any case, else false."""
    return F.when(F.trim(text) != "", F.lower(text).isin(*TRUE_WORDS))


def business_name(text: Column) -> Column:
    """Lower-case, trimmed form of a name that serves as a business key."""
    return F.lower(F.trim(text))


def split_names(text: Column) -> Column:
    """Array of the single names in a multi-valued name.

    The row's own separator decides: ";" if it occurs, else ",". Parts are trimmed and blank parts dropped; a name
    without a separator is kept as it is, even when blank.
    """

    def parts(separator: str) -> Column:
        return F.filter(F.transform(F.split(text, separator), lambda part: F.trim(part)), lambda part: part != "")

    return (
        F.when(text.contains(";"), parts(";"))
        .when(text.contains(","), parts(","))
        .when(text.isNotNull(), F.array(F.trim(text)))
    )


def stable_round(column: Column, digits: int) -> Column:
    """Round half up, after shaving off the noise of floating-point sums.

    A sum of doubles depends on the order in which partial results meet, so a rerun (or a lost executor) may move the
    last bit and flip a tie. Six digits beyond the wanted ones settle that first.
    """
    return F.round(F.round(column, digits + 6), digits)
