"""Pairs of a DataFrame plan and the same in DuckDB's SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


class Registry(dict[str, tuple[Plan, str | None]]):
    """name -> (plan, SQL or None)."""

    def paired(self, sql: str | None) -> Callable[[Plan], Plan]:
        def add(f: Plan) -> Plan:
            self[f.__name__] = f, sql
            return f

        return add
