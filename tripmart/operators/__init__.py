"""Reusable DataFrame operations: joins to dimensions, quality rules, sinks, checks."""
