"""Aggregated data marts over TPC-H-shaped tables, written for Spark.

Every operator takes DataFrames and returns a DataFrame; nothing here starts a
session, collects rows to the driver or assumes where the tables live.
"""

from martloom.contracts import CONTRACTS, ContractError
from martloom.plans.marts import (
    MARTS,
    mart_customers,
    mart_lineitems,
    mart_lineitems_core,
    mart_orders,
    mart_parts,
    mart_suppliers,
)
from martloom.plans.run import MartStatus, run_marts

__all__ = [
    "CONTRACTS",
    "MARTS",
    "ContractError",
    "MartStatus",
    "mart_customers",
    "mart_lineitems",
    "mart_lineitems_core",
    "mart_orders",
    "mart_parts",
    "mart_suppliers",
    "run_marts",
]
