import datetime as dt

import pytest

from marketlens.operators import features as X


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def market(spark):
    customers = spark.createDataFrame(
        [("c1", "p1", "SP", "A"), ("c2", "p1", "RJ", "B"), ("c3", "p2", "MG", "C"), ("c4", "p3", "BA", "D")],
        "customer_id string, customer_unique_id string, customer_state string, customer_city string",
    )
    orders = spark.createDataFrame(
        [
            ("o1", "c1", ts("2017-01-01"), ts("2017-01-11"), ts("2017-01-06")),
            ("o2", "c2", ts("2017-01-31"), ts("2017-02-02"), ts("2017-02-06")),
            ("o3", "c2", ts("2017-03-02"), None, ts("2017-03-12")),
            ("o4", "c3", ts("2017-03-02"), None, ts("2017-03-12")),
        ],
        "order_id string, customer_id string, order_purchase_timestamp timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    )
    items = spark.createDataFrame(
        [("o1", 1, "x", 10.0, 1.0), ("o2", 1, "y", 20.0, 2.0), ("o3", 1, "x", 30.0, 3.0), ("o3", 2, "y", 40.0, 4.0)],
        "order_id string, order_item_id int, product_id string, price double, freight_value double",
    )
    products = spark.createDataFrame([("x", "toys", None), ("y", "books", "Books")], "product_id string, product_category_name string, category_name_english string")
    payments = spark.createDataFrame(
        [("o1", 1, "voucher", 1, 5.0), ("o1", 2, "boleto", 1, 6.0), ("o2", 1, "boleto", 3, 22.0), ("o3", 1, "voucher", 1, 77.0)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    reviews = spark.createDataFrame([("r1", "o1", 5), ("r2", "o2", 2)], "review_id string, order_id string, review_score int")
    from marketlens.operators.clean import item_rollup

    return dict(customers=customers, orders=item_rollup(orders, items), items=items, products=products, payments=payments, reviews=reviews)


def test_feature_store_row(market):
    rows = {r["customer_unique_id"]: r for r in X.feature_store(**market).collect()}
    assert list(rows["p1"].asDict()) == X.FEATURE_COLUMNS and len(X.FEATURE_COLUMNS) == 36
    p = rows["p1"]
    assert (p["state"], p["city"], p["frequency_orders"], p["monetary_value"]) == ("RJ", "B", 3, 110.0)
    assert p["customer_age_days"] == 60.0 and p["recency_days"] == 0.0
    assert p["days_between_orders_mean"] == 30.0 and p["repeat_purchase_rate"] == 0.6667
    assert p["favorite_product_category"] == "Books"  # two each: the smaller name wins
    assert p["preferred_payment_method"] == "boleto" and p["voucher_usage_ratio"] == 0.5
    assert (p["avg_delivery_days"], p["avg_delivery_delay"], p["late_delivery_ratio"]) == (6.0, 0.5, 0.5)
    assert (p["avg_review_score"], p["positive_review_ratio"], p["negative_review_ratio"]) == (3.5, 0.5, 0.5)
    lone = rows["p2"]
    assert (lone["order_value_std"], lone["avg_review_score"], lone["preferred_payment_method"]) == (0.0, 0.0, "Uncategorized")
    never = rows["p3"]
    assert (never["state"], never["recency_days"], never["customer_age_days"], never["first_purchase_date"]) == ("BA", 999.0, 0.0, "Unknown")
    # two persons tie at zero revenue: average ranks 1.5, 1.5, 3
    assert [rows[k]["revenue_rank_percentile"] for k in ("p2", "p3", "p1")] == [50.0, 50.0, 100.0]


def test_cutoff_is_strict_and_horizon_half_open(spark):
    cut = ts("2017-06-01")
    stamps = {"before": cut - dt.timedelta(seconds=1), "at": cut, "last": cut + dt.timedelta(days=90, seconds=-1), "after": cut + dt.timedelta(days=90)}
    customers = spark.createDataFrame([(k, k, "SP", "A") for k in stamps] + [("both", "both", "RJ", "B")], "customer_id string, customer_unique_id string, customer_state string, customer_city string")
    rows = [(f"o-{k}", k, t) for k, t in stamps.items()] + [("b1", "both", stamps["before"]), ("b2", "both", stamps["last"]), ("b3", "both", stamps["after"])]
    orders = spark.createDataFrame([(o, c, t, None, None) for o, c, t in rows], "order_id string, customer_id string, order_purchase_timestamp timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp")
    items = spark.createDataFrame([(o, 1, 10.0, 1.0) for o, _, _ in rows], "order_id string, order_item_id int, price double, freight_value double")
    payments = spark.createDataFrame([], "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    reviews = spark.createDataFrame([], "review_id string, order_id string, review_score int")
    got = {r["customer_unique_id"]: r for r in X.temporal_features(customers, orders, items, payments, reviews, "2017-06-01").collect()}
    assert set(got) == {"before", "both"}  # observed customers only
    assert got["before"]["target_future_clv"] == 0.0 and got["both"]["target_future_clv"] == 10.0
    for r in got.values():
        assert r["target_repeat_buyer"] == int(r["target_future_clv"] > 0)
        assert r["obs_customer_age_days"] >= r["obs_recency_days"] >= 0
        assert (r["obs_preferred_payment"], r["obs_avg_review_score"], r["obs_avg_installments"]) == ("credit_card", 4.0, 1.0)
        assert r["obs_frequency_orders"] == 1 and r["first_purchase_date"] < "2017-06-01"


def test_first_order_gives_state_and_city_and_orders_are_counted_once(spark):
    """Two rows of one order, a tie in time, and an order without a person."""
    ts = "cast(order_purchase_timestamp as timestamp_ntz) order_purchase_timestamp"
    nothing = "cast(null as timestamp_ntz)"
    customers = spark.createDataFrame([(1, 10, "SP", "a"), (2, 10, "RJ", "b"), (3, None, "MG", "c")], "customer_id long, customer_unique_id long, customer_state string, customer_city string")
    rows = [(5, 2, "2017-01-02"), (4, 1, "2017-01-02"), (4, 1, "2017-01-02"), (6, 3, "2017-01-03")]
    orders = spark.createDataFrame(rows, "order_id long, customer_id long, order_purchase_timestamp string").selectExpr(
        "order_id", "customer_id", ts, f"{nothing} order_delivered_customer_date", f"{nothing} order_estimated_delivery_date"
    )
    items = spark.createDataFrame([(4, 1, 2.0, 1.0)], "order_id long, order_item_id int, price double, freight_value double")
    payments = spark.createDataFrame([(4, 1, "boleto", 1, 3.0)], "order_id long, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    reviews = spark.createDataFrame([(1, 4, 5)], "review_id long, order_id long, review_score int")
    out = X.temporal_features(customers, orders, items, payments, reviews, "2017-06-01")
    got = {r["customer_unique_id"]: (r["customer_state"], r["customer_city"], r["obs_frequency_orders"]) for r in out.collect()}
    assert got == {10: ("SP", "a", 2), None: ("MG", "c", 1)}
    # the many sums are hashed: neither a distinct count nor a struct makes them a sorted aggregate
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "distinct order_id" not in plan and not [x for x in plan.splitlines() if "SortAggregate" in x and "delivered" in x]
