"""Distributed union-find: connected components by alternating stars.

Links are rows; every round re-hangs each node on the least node it knows
(first its larger neighbours, then its smaller ones) until nothing changes.
Minima are partially aggregated, so a hub with very many links is reduced
before the shuffle, and nothing is gathered per component or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _stars(links: DataFrame) -> DataFrame:
    """One round over links (u > v)."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    below = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(below, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(below.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link that is not the least of its component.

    ``a`` and ``b`` are orderable ids of one type; null ends, self-links and
    repeated links are ignored. The root is the component's least node. Each
    round is cut by a reliable checkpoint in the shared folder.
    """
    ensure_checkpoint_dir(links.sparkSession)
    now = (
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
        .checkpoint()
    )
    print_of = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    seen = print_of(now)
    while seen[0]:
        now = _stars(now).checkpoint()
        new = print_of(now)
        if new == seen:
            break
        seen = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
