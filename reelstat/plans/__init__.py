"""Registered queries, their SQL oracles, and the Spark SQL warehouse route."""
