"""All registered queries. Importing the plan modules fills the registry."""

from __future__ import annotations

from flowatlas.plans import (flow_plans, ingest_plans, io_plans, model_plans, spatial_plans,  # noqa: F401
                             stock_plans)
from flowatlas.plans.common import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
