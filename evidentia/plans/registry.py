"""Queries by name, with the SQL that checks them where SQL can express them."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *model: str):
    """Registers a function (spark, sf_dir) under its name; model names the evidence tables that its SQL reads."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            from ..tables import with_model

            SQL[f.__name__] = with_model(sql, *model) if model else sql
        return f

    return add
