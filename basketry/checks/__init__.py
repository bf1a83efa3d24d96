"""Registered queries: every operator over the benchmark tables, with the SQL that checks it."""

from __future__ import annotations


def cases():
    """All registered queries by name."""
    from basketry.checks import models, reading, relational, scalar  # noqa: F401
    from basketry.checks.registry import CASES

    return CASES
