"""Queries over the driver's tables."""

from . import core_aggs, core_columns, core_io, core_joins, reports_agents, reports_customers, reports_ledger, reports_service  # noqa: F401
from . import core_storage  # noqa: F401  takes up SQL of the others
from .registry import REGISTRY  # noqa: F401
