"""Operators for large-scale training-data pipelines.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_<name>`` query of each.  Nothing outside this
subpackage imports it.
"""
