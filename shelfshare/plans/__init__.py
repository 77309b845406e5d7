"""Registered queries and the SQL each is held against."""

from . import chain_plans, demand_plans, evaluation_plans, export_plans, pilot_plans, report_plans, source_plans  # noqa: F401
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
