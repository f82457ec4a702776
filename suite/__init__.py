"""Registered queries on the driver tables, each beside the SQL that says what it must return."""


def ORDERED() -> list[str]:
    """Names of all registered queries, in order."""
    from . import base, tables, views  # noqa: F401  (importing registers)
    return sorted(base.QUERIES)
