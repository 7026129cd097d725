"""Joins with a table of places, groups or levels whose size has been looked at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], size: int, how: str = "left") -> DataFrame:
    """Join ``rows`` with a table that has ``size`` rows and one row per key.

    Up to ``MAX_BROADCAST_ROWS`` the table is sent to every executor and the rows stay where they
    are. Beyond that both sides are shuffled, and adaptive execution splits the hot keys.
    """
    return rows.join(F.broadcast(table) if size <= MAX_BROADCAST_ROWS else table, keys, how)
