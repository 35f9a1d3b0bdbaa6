"""Declarative rules per dataset, and the column types of the curated tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Brazilian state codes.
STATES = (
    "AC AL AM AP BA CE DF ES GO MA MG MS MT PA PB PE PI PR RJ RN RO RR RS SC SE SP TO".split()
)

# Order lifecycle.
ORDER_STATUSES = (
    "created approved processing invoiced shipped delivered unavailable canceled".split()
)

# Payment types.
PAYMENT_TYPES = "credit_card boleto voucher debit_card not_defined".split()


#: A raw row's text, where the reader found too few or too many fields.
MALFORMED = "_malformed"


@dataclass(frozen=True)
class Bounds:
    low: float | None = None
    high: float | None = None
    allow_zero: bool = True


@dataclass(frozen=True)
class DatasetRules:
    """``types`` lists every known column with its logical type: text, whole or number."""

    name: str
    types: dict[str, str]
    primary_key: str | None = None
    composite_key: tuple[str, ...] = ()
    optional: frozenset[str] = frozenset()
    enums: dict[str, list[str]] = field(default_factory=dict)
    bounds: dict[str, Bounds] = field(default_factory=dict)
    date_fields: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return [c for c in self.types if c not in self.optional]

    @property
    def key(self) -> tuple[str, ...]:
        return (self.primary_key,) if self.primary_key else self.composite_key

    def raw_schema(self) -> T.StructType:
        """All text: bad values must arrive and be counted, not fail the read."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.types])


def _types(text: str = "", whole: str = "", number: str = "", order: str = "") -> dict[str, str]:
    kinds = {c: "text" for c in text.split()} | {c: "whole" for c in whole.split()}
    kinds |= {c: "number" for c in number.split()}
    return {c: kinds[c] for c in order.split()} if order else kinds


RULES: dict[str, DatasetRules] = {
    r.name: r
    for r in [
        DatasetRules(
            "customers",
            _types(
                text="customer_id customer_unique_id customer_city customer_state",
                whole="customer_zip_code_prefix",
                order="customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
            ),
            primary_key="customer_id",
            enums={"customer_state": STATES},
            bounds={"customer_zip_code_prefix": Bounds(0, 99999)},
        ),
        DatasetRules(
            "orders",
            _types(
                text="order_id customer_id order_status order_purchase_timestamp order_approved_at "
                "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"
            ),
            primary_key="order_id",
            optional=frozenset(
                ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]
            ),
            enums={"order_status": ORDER_STATUSES},
            date_fields=(
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
        ),
        DatasetRules(
            "order_items",
            _types(
                text="order_id product_id seller_id shipping_limit_date",
                whole="order_item_id",
                number="price freight_value",
                order="order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
            ),
            composite_key=("order_id", "order_item_id"),
            bounds={"order_item_id": Bounds(1), "price": Bounds(0), "freight_value": Bounds(0)},
            date_fields=("shipping_limit_date",),
        ),
        DatasetRules(
            "products",
            _types(
                text="product_id product_category_name",
                number="product_name_lenght product_description_lenght product_photos_qty product_weight_g "
                "product_length_cm product_height_cm product_width_cm",
            ),
            primary_key="product_id",
            optional=frozenset(
                "product_category_name product_name_lenght product_description_lenght product_photos_qty "
                "product_weight_g product_length_cm product_height_cm product_width_cm".split()
            ),
            bounds={
                c: Bounds(0)
                for c in "product_name_lenght product_description_lenght product_photos_qty product_weight_g "
                "product_length_cm product_height_cm product_width_cm".split()
            },
        ),
        DatasetRules(
            "payments",
            _types(
                text="order_id payment_type",
                whole="payment_sequential payment_installments",
                number="payment_value",
                order="order_id payment_sequential payment_type payment_installments payment_value",
            ),
            composite_key=("order_id", "payment_sequential"),
            enums={"payment_type": PAYMENT_TYPES},
            bounds={"payment_sequential": Bounds(1), "payment_installments": Bounds(0), "payment_value": Bounds(0)},
        ),
        DatasetRules(
            "reviews",
            _types(
                text="review_id order_id review_comment_title review_comment_message review_creation_date "
                "review_answer_timestamp",
                whole="review_score",
                order="review_id order_id review_score review_comment_title review_comment_message "
                "review_creation_date review_answer_timestamp",
            ),
            composite_key=("review_id", "order_id"),
            optional=frozenset(["review_comment_title", "review_comment_message"]),
            bounds={"review_score": Bounds(1, 5)},
            date_fields=("review_creation_date", "review_answer_timestamp"),
        ),
        DatasetRules(
            "translations",
            _types(text="product_category_name product_category_name_english"),
            primary_key="product_category_name",
        ),
        # Read and header-checked only: these two take no part in the pipeline.
        DatasetRules(
            "sellers",
            _types(
                text="seller_id seller_city seller_state",
                whole="seller_zip_code_prefix",
                order="seller_id seller_zip_code_prefix seller_city seller_state",
            ),
        ),
        DatasetRules(
            "geolocation",
            _types(
                text="geolocation_city geolocation_state",
                whole="geolocation_zip_code_prefix",
                number="geolocation_lat geolocation_lng",
                order="geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state",
            ),
        ),
    ]
}

PIPELINE_DATASETS = ("translations", "customers", "products", "orders", "order_items", "payments", "reviews")


def _columns(spec: str) -> dict[str, str]:
    return dict(pair.split() for pair in spec.split(", "))


# Target column -> type of the curated tables; translations feed products and are not kept.
CURATED: dict[str, dict[str, str]] = {
    "customers": _columns(
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "products": _columns(
        "product_id string, product_category_name string, category_name_english string, "
        "product_name_lenght double, product_description_lenght double, product_photos_qty double, "
        "product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double, "
        "product_volume_cm3 double, volumetric_weight_g double"
    ),
    "orders": _columns(
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp, "
        "order_items_qty bigint, total_items_price decimal(18,2), total_freight_value decimal(18,2), "
        "order_value decimal(18,2), fulfillment_days double, delivery_days double, delivery_delay_days double, "
        "is_delivered boolean, is_late_delivery boolean"
    ),
    "order_items": _columns(
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp, "
        "price decimal(18,2), freight_value decimal(18,2)"
    ),
    "payments": _columns(
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value decimal(18,2), is_installment_payment boolean, is_voucher_payment boolean"
    ),
    "reviews": _columns(
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp, "
        "has_comment_title boolean, has_comment_message boolean"
    ),
}

# Parents before children, so foreign keys hold at every moment.
LOAD_LEVELS = (("customers", "products"), ("orders",), ("order_items", "payments", "reviews"))
