"""Semi-join reduction: drop a fact's rows whose key cannot be wanted before the work on them.

A join that keeps few keys of a large fact is preceded by a filter on the
fact's scan, so parsing, aggregation and shuffles see the wanted rows only.
The filter is a table of hashed key bits (a Bloom filter with one hash
function): its size is fixed by ``bits``, whatever the keys, so it is always
safe to broadcast. A row it lets through may still find no partner; the exact
join comes later and decides. With far more keys than ``bits`` it lets most
rows through and costs one pass over the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD, _BITS = "_reduce_word", "_reduce_bits"


def _spot(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_bits(keys: DataFrame, key: str, bits: int = 1 << 22) -> DataFrame:
    """The hashed bits of ``keys``' values: at most ``bits`` / 64 rows of two longs, broadcast."""
    spot = _spot(F.col(key), bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.where(F.col(key).isNotNull()).groupBy(F.shiftright(spot, 6).alias(_WORD)).agg(F.bit_or(one).alias(_BITS))
    return F.broadcast(words)


def keep_possible(df: DataFrame, keys: DataFrame, key: str, bits: int = 1 << 22) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among those of ``keys`` (every one that is, and about keys / bits of the
    others); null keys go. Columns and repeated rows stay as they are.

    ``bits`` is a power of two; the default's table takes about a megabyte and lets a tenth of the unwanted rows
    through at 400,000 keys.
    """
    if bits < 64 or bits & (bits - 1):
        raise ValueError("bits must be a power of two, at least 64")
    spot = _spot(F.col(key), bits)
    hit = F.call_function("shiftrightunsigned", F.col(_BITS), spot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    marked = df.where(F.col(key).isNotNull()).withColumn(_WORD, F.shiftright(spot, 6))
    return marked.join(key_bits(keys, key, bits), _WORD).where(hit).select(*[F.col(f"`{c}`") for c in df.columns])
