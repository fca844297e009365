"""Deposit analytics and two-source ledger reconciliation on Spark DataFrames."""

__version__ = "0.1.0"
