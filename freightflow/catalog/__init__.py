"""Every operator as a query over the star-schema tables, with its DuckDB equivalent."""

from .oracle import ORACLE
from .queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
