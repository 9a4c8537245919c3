"""All registered queries."""

from tiffin.catalog import (  # noqa: F401
    models,
    relational,
    scalars,
    synthesis,
    money_and_text,
    checks,
    maintenance,
    streams,
)
from tiffin.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
