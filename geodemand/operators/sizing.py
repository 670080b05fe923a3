"""Broadcast only what is proven small.

Place lists, centre lists and horizons are parameters or dimension tables;
:func:`bounded_broadcast` checks their row count (at most ``max_rows + 1`` tiny
rows are fetched, cheap on a small table) before hinting a broadcast, and otherwise leaves
the join to the planner (sort-merge, with AQE converting it at run time if the
side turns out small and splitting skewed partitions if not).

Sides derived from the big fact (e.g. the station -> place map) are never
counted eagerly: that would run the fact scan twice. AQE measures them when
their shuffle stage materialises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default ceiling for a broadcast side: rows of a place/centre list.
MAX_BROADCAST_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.

    Small ceilings fetch at most ``max_rows + 1`` one-column rows, partition
    by partition, without a shuffle; large ones count a ``LIMIT`` instead.
    """
    if max_rows <= 100_000:
        return len(df.select(F.lit(1)).take(max_rows + 1)) <= max_rows
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` has at most ``max_rows`` rows, else ``df``."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
