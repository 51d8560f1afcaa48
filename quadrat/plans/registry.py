"""Named queries, each with the SQL that gives the same rows where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from .views import with_views


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register ``fn(spark, folder)`` under ``name``; ``views`` lists the views of the SQL."""

    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder)

        REGISTRY[name] = Query(run, with_views(sql, *views.split()) if sql else None)
        return fn

    return wrap
