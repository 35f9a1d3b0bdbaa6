import pytest

from marketlens.model import RULES
from marketlens.operators import quality as Q

COLS = list(RULES["orders"].types)


def orders(spark, *rows):
    base = dict.fromkeys(COLS)
    full = [tuple({**base, **r}[c] for c in COLS) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in COLS))


def order(oid, cust="c1", status="delivered", purchase="2017-01-01", est="2017-02-01", **more):
    return dict(order_id=oid, customer_id=cust, order_status=status, order_purchase_timestamp=purchase, order_estimated_delivery_date=est, **more)


def dirty(spark):
    return orders(
        spark,
        order("1", order_approved_at="2016-12-31", order_delivered_carrier_date="2016-12-30", order_delivered_customer_date="2016-12-29"),
        order("2", status="lost"),
        order("2", cust="ghost"),
        order("3", cust=None, purchase="not a date"),
        order("4", status=None),
    )


def counts(report):
    return {r["check"]: (r["status"], r["severity"], r["violations"]) for r in report.collect()}


def test_each_order_check(spark):
    parents = {"customers": spark.createDataFrame([("c1",)], "customer_id string")}
    got = counts(Q.quality_report("orders", dirty(spark), parents))
    assert got["primary_key_uniqueness"] == ("FAILED", "ERROR", 2)
    assert got["primary_key_nulls"] == ("PASSED", "INFO", 0)
    assert got["nullable_fields"][2] == 2  # one customer, one status
    assert got["enum_fields"][2] == 1  # null status is not an enum violation
    assert got["orders_status"][2] == 2  # but is no valid status either
    assert got["date_fields"][2] == 1
    assert got["orders_timestamp_sequence"] == ("WARNING", "WARNING", 3)  # one row, three comparisons
    assert got["orders_customer_foreign_key"][2] == 2  # unknown and null


def test_null_key_is_critical_and_stops_the_pipeline(spark):
    summary = Q.quality_summary(Q.quality_report("orders", orders(spark, order(None), order("1"))))
    assert summary.first()["critical_count"] == 1
    with pytest.raises(Q.CircuitBreaker, match="orders"):
        Q.require_no_critical(summary)
    Q.require_no_critical(Q.quality_summary(Q.quality_report("orders", dirty(spark))))


def test_missing_and_unexpected_columns(spark):
    df = spark.createDataFrame([("1", "x")], "customer_id string, extra string")
    assert len(Q.missing_columns(df, RULES["customers"])) == 4
    assert Q.unexpected_columns(df, RULES["customers"]) == ["extra"]
    got = counts(Q.quality_report("customers", df))
    assert got["required_columns"][:2] == ("FAILED", "CRITICAL") and got["unexpected_columns"][0] == "WARNING"


def test_rows_and_quarantine(spark):
    parents = {"customers": spark.createDataFrame([("c1",)], "customer_id string")}
    good, bad = Q.split_quarantine("orders", dirty(spark), parents)
    assert good.count() == 0 and bad.count() == 5
    reasons = {(r["order_id"], r["order_status"], r["customer_id"]): set(r["_violations"]) for r in bad.collect()}
    assert reasons[("2", "delivered", "ghost")] == {"primary_key_uniqueness", "orders_customer_foreign_key"}
    n = Q.invalid_row_counts("orders", dirty(spark), parents)
    with pytest.raises(Q.CircuitBreaker, match="100.00%"):
        Q.require_error_rate(n)
    Q.require_error_rate(n, 1.0)


def test_numeric_domains(spark):
    pay = spark.createDataFrame(
        [("o", "1", "boleto", "1", "5"), ("o", "1", "cash", "-1", "-2"), ("o", "0", "voucher", None, "x")],
        "order_id string, payment_sequential string, payment_type string, payment_installments string, payment_value string",
    )
    got = counts(Q.quality_report("payments", pay))
    assert got["composite_key_uniqueness"][2] == 2
    assert got["numeric_constraints"][2] == 3  # sequential 0, installments -1, value -2; text is ignored
    assert got["payments_value"][2] == 2 and got["payments_installments"][2] == 2
    rev = spark.createDataFrame([(s,) for s in ("0", "3", "6", "x", None)], "review_score string")
    assert counts(Q.quality_report("reviews", rev))["reviews_score_range"][2] == 4
    prod = spark.createDataFrame([("1", -1.0), ("2", None)], "product_id string, product_width_cm double")
    assert counts(Q.quality_report("products", prod))["products_dimensions"][2] == 1
    cust = spark.createDataFrame([("SP", "100000"), (None, "1"), ("ZZ", None)], "customer_state string, customer_zip_code_prefix string")
    got = counts(Q.quality_report("customers", cust))
    assert got["customers_state_code"][2] == 2 and got["customers_zip_bounds"][2] == 2


def test_null_composite_keys_compare_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "order_id string, order_item_id int")
    one = Q.key_violations(df, ["order_id", "order_item_id"]).first()
    assert (one["duplicate_rows"], one["surplus_rows"], one["null_key_rows"]) == (2, 1, 2)
