"""Attaching a customer table to transactions when one customer may own most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorespark.session import materialize


def attach(rows: DataFrame, table: DataFrame, key: str = "customer_id", *, cut: bool = True) -> DataFrame:
    """Left equi-join of ``rows`` with a table that has one row per ``key``.

    The table is written first.  Spark then knows its size: below the session's
    broadcast threshold ``rows`` are not shuffled at all; above it both sides
    are shuffled plainly, which is the form whose oversized partitions adaptive
    execution splits over several tasks.  Joining an aggregate directly would
    reuse its partitioning and leave a hot key in one task.

    ``cut=False`` skips the write for a table that is already stored.
    """
    stored = materialize(table, "attach") if cut else table
    return rows.join(stored, key, "left")
