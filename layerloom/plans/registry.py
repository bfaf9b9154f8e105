"""All registered queries: importing the query modules fills the catalog."""

from layerloom.plans import (  # noqa: F401
    function_queries,
    ingest_queries,
    model_queries,
    quality_queries,
    warehouse_queries,
)
from layerloom.plans.catalog import ENTRIES

__all__ = ["ENTRIES"]
