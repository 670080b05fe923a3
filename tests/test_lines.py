from decimal import Decimal

from pyspark.sql import functions as F

from geodemand.operators.lines import explode_lines, order_amounts

ONE = '[{"price":"10.00","qty":"2","promotion_info":{"promo_disc":0.1}}]'
BARE = '{"price":"5.00","qty":"1"}'
BAD_DISC = '[{"price":"4.00","qty":"1","promotion_info":{"promo_disc":"x"}}]'


def test_explode_lines_cases(spark):
    rows = [(1, ONE), (2, "[]"), (3, "not json"), (4, BARE), (5, None), (6, BAD_DISC)]
    df = spark.createDataFrame(rows, "o int, j string")
    got = {r.o: r.n for r in explode_lines(df, "j", keep=["o"]).groupBy("o").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 1, 4: 1, 6: 1}


def test_order_amounts_round_each_line(spark):
    # 0.333 x 1 x (1 - 0.5) = 0.1665 -> 0.17 per line; two lines sum to 0.34 (not 0.33)
    j = '[{"price":"0.333","qty":"1","promotion_info":{"promo_disc":0.5}},{"price":"0.333","qty":"1","promotion_info":{"promo_disc":0.5}}]'
    df = spark.createDataFrame([(1, 7, 1570000000, j), (2, 7, None, ONE)], "order_number long, customer_id long, order_datetime long, ordered_products string")
    out = order_amounts(df).collect()
    assert len(out) == 1  # the order without a time is skipped
    # price is cast to decimal(18,2) first: 0.33 x 1 x 0.5 = 0.165 -> 0.17 per line
    assert out[0].order_sales_amount == Decimal("0.34")
    assert str(out[0].order_date) == "2019-10-02"


def test_null_discount_is_zero(spark):
    j = '[{"price":"3.00","qty":"2"}]'
    df = spark.createDataFrame([(1, 1, 1570000000, j)], "order_number long, customer_id long, order_datetime long, ordered_products string")
    assert order_amounts(df).first().order_sales_amount == Decimal("6.00")


def test_order_split_over_rows_sums_back(spark):
    a = '[{"price":"1.00","qty":"1"},{"price":"2.00","qty":"1"}]'
    b = '[{"price":"4.00","qty":"1"}]'
    df = spark.createDataFrame(
        [(1, 7, 1570000000, a), (1, 7, 1570000000, b), (2, 7, 1570000000, "[]")],
        "order_number long, customer_id long, order_datetime long, ordered_products string",
    )
    out = order_amounts(df).collect()
    assert [(r.order_number, r.order_sales_amount) for r in out] == [(1, Decimal("7.00"))]


def test_place_day_sales_matches_per_order_join(spark):
    from geodemand.plans.sales import place_day_sales

    j = '[{"price":"10.00","qty":"1"}]'
    orders = spark.createDataFrame(
        [(1, 1, 1570000000, j), (2, 1, 1570000000, j), (3, 2, 1570000000, j), (4, 3, 1570000000, j)],
        "order_number long, customer_id long, order_datetime long, ordered_products string",
    )
    customers = spark.createDataFrame([(1, "A", "X"), (2, "A", "X"), (3, None, "X")], "customer_id long, city string, state string")
    out = place_day_sales(orders, customers, year=2022, month=1).collect()
    assert [(r.city, r.state, str(r.date), r.sales_amount) for r in out] == [("A", "X", "2022-01-02", Decimal("30.00"))]
