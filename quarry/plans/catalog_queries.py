"""All modules that register queries."""

from quarry.plans import aggregation, expressions, relational, tpch  # noqa: F401
