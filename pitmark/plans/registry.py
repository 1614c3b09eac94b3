"""Where queries on the test tables are registered, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitmark.plans.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL that may name views; the catalogue puts these in front.
BODIES: dict[str, str] = {}
#: What each query makes of its views.
BUILDS: dict[str, Callable[[Views], DataFrame]] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(views)`` under a name; ``sql`` may name views."""

    def add(build: Callable[[Views], DataFrame]):
        BUILDS[name] = build
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            BODIES[name] = sql
        return build

    return add
