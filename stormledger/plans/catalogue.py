"""All registered queries and their checks."""

from stormledger.plans import climate_queries, curation_queries, panel_queries  # noqa: F401
from stormledger.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
