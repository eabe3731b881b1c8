"""The operators applied to the given test tables, with equivalent SQL."""

from __future__ import annotations


def all_checks():
    """Name -> check, from every module that registers some."""
    from kohortflow.checks import cohorts, files, summaries, tables  # noqa: F401
    from kohortflow.checks.registry import CHECKS

    return dict(CHECKS)
