"""All registered queries, by area."""

from . import (  # noqa: F401
    catalog_actives,
    catalog_aggregates,
    catalog_churn,
    catalog_customers,
    catalog_expressions,
    catalog_joins,
    catalog_models,
    catalog_quality,
    catalog_reports,
    catalog_sources,
    catalog_star,
)
from .registry import oracles, registered  # noqa: F401
