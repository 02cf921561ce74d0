"""Every query by name, with its SQL where SQL can express it."""

from __future__ import annotations

from .queries import QUERIES
from .sql import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]
