"""Payment reports: methods, installments, values, behaviour, trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exprs import count_if, dbl, money, money_mean, money_total, pct, ratio, total, year_month
from marketlens.functions.ordering import describe, distinct_values
from marketlens.model import PAYMENT_TYPES


def value() -> Column:
    return money("payment_value")


def payment_methods(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("transactions"),
        money_total("payment_value").alias("revenue"),
        F.countDistinct("order_id").alias("orders"),
        F.round(money_mean("payment_value"), 2).alias("average_value"),
    )


def installment_counts(payments: DataFrame) -> DataFrame:
    return (
        payments.filter(F.col("payment_installments").isNotNull())
        .groupBy(F.col("payment_installments").cast("long").alias("installments"))
        .agg(F.count(F.lit(1)).alias("transactions"), money_total("payment_value").alias("revenue"))
    )


def installment_means(payments: DataFrame) -> DataFrame:
    n = F.col("payment_installments")
    card = F.when(F.col("payment_type") == "credit_card", n)
    return payments.agg(
        F.round(ratio(F.sum(n), F.count(n)), 2).alias("average_installments"),
        F.round(ratio(F.sum(card), F.count(card)), 2).alias("average_installments_credit_card"),
    )


def installment_split(payments: DataFrame) -> DataFrame:
    """One-time (1) against installment (> 1) payments; 0 installments are in neither."""
    n = F.col("payment_installments")
    kinds = {"one_time": n == 1, "installment": n > 1}
    one = payments.agg(
        F.count(F.lit(1)).alias("rows"),
        total(value()).alias("value"),
        *[count_if(c).alias(f"n_{k}") for k, c in kinds.items()],
        *[total(F.when(c, value())).alias(f"v_{k}") for k, c in kinds.items()],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("kind"),
                F.col(f"n_{k}").alias("transactions"),
                pct(F.col(f"n_{k}"), F.col("rows")).alias("transaction_percentage"),
                F.round(dbl(f"v_{k}"), 2).alias("revenue"),
                pct(F.col(f"v_{k}"), F.col("value")).alias("revenue_percentage"),
            )
            for k in kinds
        ]
    )
    return one.select(F.inline(rows))


def payment_value_stats(payments: DataFrame) -> DataFrame:
    """Value statistics and 1.5 IQR outliers; the fences come from the rounded quartiles."""
    d = describe(payments, "payment_value").select(
        F.col("n"),
        F.round("total", 2).alias("total_payment_value"),
        *[F.round(c, 2).alias(c) for c in ("mean", "median", "min", "max", "q25", "q75")],
    )
    spread = (F.col("q75") - F.col("q25")) * 1.5
    d = d.withColumn("lower_bound", F.round(F.col("q25") - spread, 2)).withColumn(
        "upper_bound", F.round(F.col("q75") + spread, 2)
    )
    per_value = distinct_values(payments, "payment_value")
    v = dbl("payment_value")
    fences = d.select("lower_bound", "upper_bound")
    outliers = per_value.crossJoin(F.broadcast(fences)).agg(  # one row of fences
        F.coalesce(F.sum(F.when((v < F.col("lower_bound")) | (v > F.col("upper_bound")), F.col("n"))), F.lit(0)).alias("outlier_count")
    )
    return d.crossJoin(F.broadcast(outliers)).withColumn("outlier_percentage", pct(F.col("outlier_count"), F.col("n")))


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.count("payment_sequential").alias("payments"))


def multiple_payments(payments: DataFrame) -> DataFrame:
    """Orders by number of payments, with the share of all paid orders."""
    hist = payments_per_order(payments).groupBy("payments").agg(F.count(F.lit(1)).alias("orders"))
    whole = hist.agg(
        F.sum("orders").alias("all_orders"), total(F.when(F.col("payments") > 1, F.col("orders"))).alias("multi")
    )
    return hist.crossJoin(F.broadcast(whole)).select(  # one row
        "payments",
        "orders",
        F.col("multi").alias("orders_with_multiple_payments"),
        pct(F.col("multi"), F.col("all_orders")).alias("multiple_percentage"),
    )


def voucher_usage(payments: DataFrame) -> DataFrame:
    voucher = F.col("payment_type") == "voucher"
    # Order and voucher flag first: the distinct order counts become plain sums.
    per_order = payments.groupBy("order_id").agg(
        count_if(voucher).alias("vouchers"), F.sum(F.when(voucher, value())).alias("paid")
    )
    with_voucher = count_if(F.col("vouchers") > 0)
    return per_order.agg(
        total("vouchers").alias("voucher_transaction_count"),
        money_total("paid").alias("voucher_total_revenue"),
        with_voucher.alias("voucher_orders_count"),
        pct(with_voucher, F.count(F.lit(1))).alias("voucher_orders_percentage"),
        F.round(ratio(total("paid"), total("vouchers")), 2).alias("average_voucher_value"),
    )


def dominant_method(payments: DataFrame, method: str = "credit_card") -> DataFrame:
    mine = F.col("payment_type") == method
    return payments.agg(
        count_if(mine).alias("transaction_count"),
        money_total(F.when(mine, value())).alias("revenue"),
        pct(count_if(mine), F.count(F.lit(1))).alias("transaction_share_percent"),
        pct(total(F.when(mine, value())), total(value())).alias("revenue_share_percent"),
    )


def payment_trend(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue per month and payment type, 0 where a type is absent."""
    per_order = payments.groupBy("order_id", "payment_type").agg(F.sum(value()).alias("paid"))
    months = orders.select("order_id", year_month("order_purchase_timestamp").alias("year_month"))
    return (
        per_order.join(months, "order_id")
        .filter(F.col("year_month").isNotNull())
        .groupBy("year_month")
        .agg(*[money_total(F.when(F.col("payment_type") == t, F.col("paid"))).alias(t) for t in PAYMENT_TYPES])
    )


def payment_business(payments: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    n = F.col("payment_installments")
    people = customers.agg(F.countDistinct("customer_unique_id").alias("people"))
    number = orders.agg(F.countDistinct("order_id").alias("orders"))
    one = payments.agg(
        total(value()).alias("value"),
        total(F.when(n > 1, value())).alias("split"),
        *[total(F.when(F.col("payment_type") == t, value())).alias(f"v_{t}") for t in PAYMENT_TYPES],
    )
    one = one.crossJoin(F.broadcast(people)).crossJoin(F.broadcast(number))  # one-row frames
    return one.select(
        *[pct(F.col(f"v_{t}"), F.col("value")).alias(f"{t}_contribution_percent") for t in PAYMENT_TYPES],
        pct(F.col("split"), F.col("value")).alias("installment_revenue_contribution_percent"),
        F.round(ratio(F.col("value"), F.col("people")), 2).alias("average_payment_per_customer"),
        F.round(ratio(F.col("value"), F.col("orders")), 2).alias("average_payment_per_order"),
        F.col("people").alias("total_unique_customers_count"),
        F.col("orders").alias("total_unique_orders_count"),
    )
