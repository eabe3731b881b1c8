"""Checks: a query over the test tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kohortflow.checks.roles import Tables, with_steps


@dataclass(frozen=True)
class Check:
    run: Callable[[Tables], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable:
    """Register a query under ``name`` with its SQL (roles and steps in braces)."""

    def register(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in CHECKS:
            raise ValueError(f"check {name} is registered twice")
        CHECKS[name] = Check(run, with_steps(sql) if sql else None)
        return run

    return register


def rounded(column: str | Column, digits: int = 3) -> Column:
    """Rounded double, named like its column."""
    col = F.col(column) if isinstance(column, str) else column
    out = F.round(col.cast("double"), digits)
    return out.alias(column) if isinstance(column, str) else out
