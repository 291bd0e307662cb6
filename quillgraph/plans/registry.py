"""All queries by name, and the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
