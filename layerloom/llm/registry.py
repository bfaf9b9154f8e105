"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from layerloom.llm import queries as q
from layerloom.llm import sql

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return q.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    own = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return sql.ORACLE | own
