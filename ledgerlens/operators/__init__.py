"""Composite operators: deposit analytics, reconciliation, aggregates, checks."""
