"""Query registry, SQL oracle and plan inspection helpers."""
