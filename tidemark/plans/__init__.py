"""Registered queries: every operator bound to the analytics tables, with the SQL that must give the same rows."""

from tidemark.plans.registry import QUERIES, SQL  # noqa: F401
