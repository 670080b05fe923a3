"""Place-day sales from orders and resolved customers (L1, L2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import remap_month
from ..operators.lines import priced_orders
from ..operators.reduce import keep_possible


def place_day_sales(
    orders: DataFrame,
    customers: DataFrame,
    year: int | None = None,
    month: int | None = None,
    lo: dt.date | str | None = None,
    hi: dt.date | str | None = None,
    overflow: str = "error",
    amount: str = "sales_amount",
    reduce_bits: int = 1 << 22,
) -> DataFrame:
    """One row per (city, state, date) with the summed order amounts.

    ``customers`` is one row per ``customer_id`` with ``city`` and ``state``
    (e.g. the output of ``resolve_places``). When ``year``/``month`` are
    given, days are re-dated into that month keeping the day of month.

    Orders of other customers are dropped at the scan, before their JSON is
    parsed, by a filter of ``reduce_bits`` hashed customer bits (exact joins
    decide later). Each remaining order row is priced in place (no explode, no per-order shuffle), then
    amounts are summed per (customer, day): exact decimal sums are
    associative, so this equals the reference's per-order sums joined to
    customers, but the join input shrinks to one row per customer and day and
    a customer holding a large share of orders is reduced map-side before any
    shuffle.
    """
    c = customers.select("customer_id", "city", "state").where(
        F.col("city").isNotNull() & F.col("state").isNotNull()
    )
    # only orders of these customers are parsed and shuffled
    per_order = priced_orders(keep_possible(orders, c, "customer_id", reduce_bits), lo, hi)
    per_customer_day = per_order.groupBy("customer_id", "order_date").agg(
        F.sum("order_sales_amount").alias("_amount")
    )
    j = per_customer_day.join(c, "customer_id")
    day = F.col("order_date")
    if year is not None or month is not None:
        if year is None or month is None:
            raise ValueError("give both year and month")
        day = remap_month(day, year, month, overflow)
    return j.groupBy("city", "state", day.alias("date")).agg(F.sum("_amount").alias(amount))
