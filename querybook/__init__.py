"""The registered queries: each a Spark callable over the given tables and, where SQL can say it, its SQL."""

from importlib import import_module

PARTS = ("timelines", "versions", "ingestion", "sequences", "expressions", "layers", "quality", "models")


def _books():
    return [import_module(f"querybook.{part}").book for part in PARTS]


def queries():
    return {name: query for book in _books() for name, query in book.queries.items()}


def oracle_sql():
    return {name: sql for book in _books() for name, sql in book.sql.items()}
