"""Named queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import Inputs, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable:
    """Registers a function of `Inputs` as a query; `sql` may read the named views."""

    def register(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Inputs(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql, views) if views else sql
        return f

    return register
