"""Registry of named queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.standins import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_MODULES = (
    "records_queries",
    "cost_queries",
    "join_queries",
    "interval_queries",
    "outcome_queries",
    "statistics_queries",
    "signal_queries",
    "agreement_queries",
    "sampling_queries",
    "efficiency_queries",
    "streaming_queries",
)


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`; `sql` may use the stand-in views as plain table names."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = Tables.with_views(sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6, **per_column: int) -> DataFrame:
    """Round the DOUBLE columns of a report, so that the order of a floating-point sum does not show."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c, per_column.get(field.name, digits)).alias(field.name)
        out.append(c)
    return df.select(*out)


def load_all() -> None:
    for module in _MODULES:
        try:
            import_module(f"tidemark.plans.{module}")
        except ModuleNotFoundError as exc:
            if exc.name != f"tidemark.plans.{module}":
                raise
