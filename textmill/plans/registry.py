"""All queries and the SQL they are compared with."""

from __future__ import annotations

from textmill.plans import corpus, encoding, examples, logs, scores, tasks, vocabulary

MODULES = [corpus, vocabulary, encoding, examples, tasks, scores, logs]


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
