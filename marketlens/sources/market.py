"""The marketplace tables an analysis works on, and the views that derive them.

``Market`` holds one lazy DataFrame per role. ``from_star_schema`` maps order / line-item /
part / supplier tables onto the roles; ``from_tables`` reads curated Parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.exprs import MONEY_TYPE, money
from marketlens.operators.clean import item_rollup, order_durations

ROLES = ("customers", "orders", "order_items", "payments", "reviews", "products", "translations", "sellers")


class Market:
    """One DataFrame per role, built when first asked for: a report reads only its own tables."""

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    translations: DataFrame
    sellers: DataFrame

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._makers = dict(makers)

    def __getattr__(self, role: str) -> DataFrame:
        if role.startswith("_") or role not in self._makers:
            raise AttributeError(role)
        frame = self._makers[role]()
        setattr(self, role, frame)
        return frame

    def as_dict(self) -> dict[str, DataFrame]:
        return {role: getattr(self, role) for role in ROLES}

    def replaced(self, **frames: Callable[[], DataFrame]) -> Market:
        kept = {role: (lambda r=role: getattr(self, r)) for role in ROLES}
        return Market({**kept, **frames})

    def curated(self) -> Market:
        """Orders with durations, flags and item totals; products with the English category."""
        return self.replaced(orders=self._curated_orders, products=self._curated_products)

    def _curated_orders(self) -> DataFrame:
        if "order_items_qty" in self.orders.columns:  # tables that the pipeline wrote have it all
            return self.orders
        return item_rollup(order_durations(self.orders), self.order_items)

    def _curated_products(self) -> DataFrame:
        if "category_name_english" in self.products.columns:
            return self.products
        english = self.translations.select(
            "product_category_name", F.col("product_category_name_english").alias("category_name_english")
        )
        volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
        return self.products.join(english, "product_category_name", "left").withColumn("product_volume_cm3", volume)


def from_tables(spark: SparkSession, base: str) -> Market:
    """Curated tables written by the pipeline, one Parquet folder per role."""
    return Market({role: (lambda r=role: spark.read.parquet(f"{base}/{r}")) for role in ROLES})


def from_star_schema(spark: SparkSession, base: str) -> Market:
    """Roles over the order / lineitem / part / supplier / customer tables in ``base``."""

    @cache
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{base}/{name}.parquet")

    return Market(
        {
            "customers": lambda: _customers(table("customer"), table("nation")),
            "orders": lambda: _orders(table("orders"), table("lineitem")),
            "order_items": lambda: _order_items(table("lineitem")),
            "payments": lambda: _payments(table("lineitem")),
            "reviews": lambda: _reviews(table("orders"), table("documents")),
            "products": lambda: _products(table("part")),
            "translations": lambda: _translations(table("part")),
            "sellers": lambda: _sellers(table("supplier"), table("nation")),
        }
    )


def _customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("customer_unique_id"),
        (F.col("c_custkey") % 100000).alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def _orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    shipped = lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    status = F.col("o_orderstatus")
    return orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(status == "F", "delivered").when(status == "O", "shipped").otherwise("canceled").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.timestamp_add("HOUR", (F.col("o_orderkey") % 48).cast("int"), F.col("o_orderdate")).alias("order_approved_at"),
        F.col("first_ship").alias("order_delivered_carrier_date"),
        F.when(status == "F", F.col("last_ship")).alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", F.lit(45), F.col("o_orderdate")).alias("order_estimated_delivery_date"),
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        money("l_extendedprice").alias("price"),
        (money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY_TYPE).alias("freight_value"),
    )


def _payments(lineitem: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    kept = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(flag == "A", "credit_card").when(flag == "N", "boleto").otherwise("voucher").alias("payment_type"),
        (F.col("l_quantity").cast("int") % 11).alias("payment_installments"),
        (money("l_extendedprice") * kept).cast(MONEY_TYPE).alias("payment_value"),
    )


def _reviews(orders: DataFrame, documents: DataFrame) -> DataFrame:
    messages = documents.select("doc_id", F.col("text").alias("review_comment_message"))
    created = F.timestamp_add("DAY", F.lit(60), F.col("o_orderdate"))
    return orders.join(messages, F.col("o_orderkey") == F.col("doc_id"), "left").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        (1 + (7 * F.col("o_orderkey") + F.col("o_custkey")) % 5).cast("int").alias("review_score"),
        F.when(F.col("o_orderkey") % 8 == 0, F.col("o_orderpriority")).alias("review_comment_title"),
        F.col("review_comment_message"),
        created.alias("review_creation_date"),
        F.timestamp_add("DAY", F.lit(2), created).alias("review_answer_timestamp"),
    )


def _products(part: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("double")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        F.length("p_brand").cast("double").alias("product_description_lenght"),
        (F.col("p_size") % 6).cast("double").alias("product_photos_qty"),
        size.alias("product_weight_g"),
        size.alias("product_length_cm"),
        (F.col("p_size") % 7 + 1).cast("double").alias("product_height_cm"),
        (F.col("p_size") % 5 + 1).cast("double").alias("product_width_cm"),
    )


def _translations(part: DataFrame) -> DataFrame:
    kinds = part.filter(F.col("p_type") != "PROMO").groupBy(F.col("p_type").alias("product_category_name"))
    return kinds.agg(F.min(F.lower("p_type")).alias("product_category_name_english"))


def _sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("seller_id"),
        (F.col("s_suppkey") % 100000).alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )
