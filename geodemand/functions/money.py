"""JSON line items and exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._cols import ColumnOrName, col

# Fixed value: schema of one ordered product in the orders' JSON text column.
LINE_ITEM_TYPE = T.StructType(
    [
        T.StructField("curr", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField(
            "promotion_info",
            T.StructType(
                [
                    T.StructField("promo_disc", T.DoubleType()),
                    T.StructField("promo_id", T.StringType()),
                    T.StructField("promo_item", T.StringType()),
                    T.StructField("promo_qty", T.StringType()),
                ]
            ),
        ),
        T.StructField("qty", T.StringType()),
        T.StructField("unit", T.StringType()),
    ]
)

# Only the fields the amount needs: from_json then materialises three fields
# per line instead of seven.
LINE_ITEM_PRICING_TYPE = T.StructType(
    [
        T.StructField("price", T.StringType()),
        T.StructField(
            "promotion_info", T.StructType([T.StructField("promo_disc", T.DoubleType())])
        ),
        T.StructField("qty", T.StringType()),
    ]
)

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 6)


def parse_lines(c: ColumnOrName, item_type: T.StructType = LINE_ITEM_PRICING_TYPE) -> Column:
    """JSON text -> ``array<struct>``; malformed text gives null (PERMISSIVE).

    A bare JSON object parses as a one-element array.
    """
    return F.from_json(col(c), T.ArrayType(item_type), {"mode": "PERMISSIVE"})


def line_amount(price: ColumnOrName, qty: ColumnOrName, disc: ColumnOrName) -> Column:
    """``price x qty x (1 - disc)`` rounded to cents, exact decimal arithmetic.

    Price and quantity are ``decimal(18,2)``, the discount ``decimal(18,6)``
    (null discount = 0). Text that is not a number, or an amount that does not
    fit, gives a null line, which ``SUM`` then skips.
    """
    p = col(price).try_cast(MONEY)
    q = col(qty).try_cast(MONEY)
    d = F.coalesce(col(disc), F.lit(0.0)).try_cast(RATE)
    one = F.lit(1).cast(RATE)
    return F.try_multiply(F.try_multiply(p, q), one - d).try_cast(MONEY)
