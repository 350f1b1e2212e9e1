"""Collects the queries and composes their SQL from shared views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracklens.workload import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register ``f(tables) -> DataFrame``; ``sql`` may refer to the views in ``uses``."""

    def register(build: Callable[[views.Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: build(views.Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = views.with_views(sql, uses)
        return build

    return register
