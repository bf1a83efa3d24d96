"""Register of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from basketry.checks.inputs import Inputs


@dataclass(frozen=True)
class Case:
    run: Callable[[Inputs], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None):
    """Register a query under a name that starts with its inventory ids."""

    def keep(run: Callable[[Inputs], DataFrame]):
        if name in CASES:
            raise ValueError(f"{name} is registered twice")
        CASES[name] = Case(run, sql)
        return run

    return keep
