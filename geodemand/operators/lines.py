"""Orders held as JSON line items -> order amounts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_day_range, epoch_to_day
from ..functions.money import LINE_ITEM_PRICING_TYPE, line_amount, parse_lines


def explode_lines(
    df: DataFrame,
    json_col: str = "ordered_products",
    item: str = "item",
    keep: list[str] | None = None,
    item_type=LINE_ITEM_PRICING_TYPE,
) -> DataFrame:
    """One row per line item; orders with null, empty or malformed JSON give
    no rows (``explode``, not ``explode_outer``)."""
    keep = keep if keep is not None else [c for c in df.columns if c != json_col]
    return df.select(*keep, F.explode(parse_lines(json_col, item_type)).alias(item))


def _null_skipping_sum(values, zero_type: str):
    """``SUM`` over an array column: nulls skipped, null when nothing is summed."""
    return F.aggregate(
        values,
        F.lit(None).cast(zero_type),
        lambda acc, x: F.when(x.isNull(), acc).when(acc.isNull(), x.cast(zero_type)).otherwise((acc + x).cast(zero_type)),
    )


def priced_orders(
    orders: DataFrame,
    lo: dt.date | str | None = None,
    hi: dt.date | str | None = None,
    order_key: str = "order_number",
    customer_key: str = "customer_id",
    epoch_col: str = "order_datetime",
    json_col: str = "ordered_products",
    amount: str = "order_sales_amount",
    day: str = "order_date",
) -> DataFrame:
    """Per input row: the order's amount, priced inside the row.

    The line array is parsed and summed with a higher-order ``aggregate``
    (each line rounded to cents, unpriceable lines skipped), so lines are not
    exploded and no shuffle is needed. Rows whose JSON is null, malformed or an empty array
    are dropped, as ``explode`` would drop them.
    """
    o = orders.where(F.col(epoch_col).isNotNull() & F.col(json_col).isNotNull())
    if lo is not None or hi is not None:
        if lo is None or hi is None:
            raise ValueError("give both lo and hi")
        o = o.where(epoch_day_range(epoch_col, lo, hi))
    # Exploded as the one element of an array, the parsed list is an input of what follows: a filter on a plain
    # column would be moved below the joins and parse every order a second time.
    parsed = o.select(order_key, customer_key, epoch_to_day(epoch_col).alias(day), F.explode(F.array(parse_lines(json_col))).alias("_items"))
    cents = F.transform(
        F.col("_items"), lambda x: line_amount(x["price"], x["qty"], x["promotion_info"]["promo_disc"])
    )
    return parsed.where(F.size("_items") > 0).select(
        order_key, customer_key, day, _null_skipping_sum(cents, "decimal(28,2)").alias(amount)
    )


def order_amounts(
    orders: DataFrame,
    lo: dt.date | str | None = None,
    hi: dt.date | str | None = None,
    order_key: str = "order_number",
    customer_key: str = "customer_id",
    epoch_col: str = "order_datetime",
    json_col: str = "ordered_products",
    amount: str = "order_sales_amount",
    day: str = "order_date",
) -> DataFrame:
    """Per-order amount: sum of lines priced ``price x qty x (1 - disc)``,
    each line rounded to cents before summing.

    Orders without a time or without lines are skipped. The optional day range
    ``[lo, hi]`` is applied to the raw epoch seconds, so the parquet scan can
    skip row groups.
    """
    rows = priced_orders(orders, lo, hi, order_key, customer_key, epoch_col, json_col, amount, day)
    # An order may span several rows (chunks of lines, or repeated rows):
    # sum them per order, as SUM over the exploded lines would.
    return rows.groupBy(order_key, customer_key, day).agg(F.sum(amount).cast("decimal(28,2)").alias(amount))
