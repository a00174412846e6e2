"""Contracts, quality gates, marts and audits for layered tables, as plain Spark DataFrames."""

from sluiceworks.contract import Contract, Reference, build_order
from sluiceworks.operators.gate import Staged, gate
from sluiceworks.session import session, workspace

__all__ = ["Contract", "Reference", "Staged", "build_order", "gate", "session", "workspace"]
