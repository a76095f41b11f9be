"""Named queries, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans.sql_views import SQL_VIEWS
from tradewind.plans.views import Views

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(views) -> DataFrame`` under a name."""
    def register(build):
        _QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            body = sql.strip()
            if body.startswith("WITH "):
                _SQL[name] = f"WITH RECURSIVE {SQL_VIEWS},\n{body[5:]}"
            else:
                _SQL[name] = f"WITH RECURSIVE {SQL_VIEWS}\n{body}"
        return build
    return register


def load_all() -> tuple[dict, dict]:
    from tradewind.plans import flows, loads, lookups, screens, shapes  # noqa: F401  (register on import)
    return dict(_QUERIES), dict(_SQL)
