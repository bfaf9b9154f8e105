"""Semi, anti and inner joins in which NULL keys match NULL keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, *, few: bool = False) -> DataFrame:
    """Join by ``keys`` with NULL equal to NULL; the keys come from the left. ``few``: the right side has a bounded number of rows and is
    sent to every task. Such a condition is hashed and shuffled like any equality."""
    names = {name: f"_right_{name}" for name in keys}
    side = right.withColumnsRenamed(names)
    condition = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(renamed)) for name, renamed in names.items()])
    joined = left.join(F.broadcast(side) if few else side, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names.values())
