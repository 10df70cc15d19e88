"""Registered queries and their SQL twins."""

from __future__ import annotations

from importlib import import_module

#: Plan modules; importing one registers its queries.
MODULES = ("evaluation", "conversations", "corpus", "events", "tasks", "answers", "lessons", "receipts", "release", "files", "streams")


def load() -> tuple[dict, dict]:
    """Import every plan module and return (queries, SQL by name)."""
    for name in MODULES:
        import_module(f"prefmill.plans.{name}")
    from prefmill.plans.registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
