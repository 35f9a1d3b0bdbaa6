"""Whole report families: every section as tidy rows, from shared bases written once.

Sections are built side by side, for some write an ordered table first, and are then the
branches of one union.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from marketlens.operators import eda_customers as cu
from marketlens.operators import eda_delivery as de
from marketlens.operators import eda_payments as pa
from marketlens.operators import eda_products as pr
from marketlens.operators import eda_reviews as re
from marketlens.operators import eda_sales as sa
from marketlens.sources.market import Market
from marketlens.sources.workspace import concurrently, stored
from marketlens.sources.writers import json_report, write_json_report


Sections = dict[str, Callable[[], DataFrame]]


def customer_sections(m: Market) -> Sections:
    customers, orders = m.customers, m.orders
    totals = stored(cu.person_totals(m.customers, m.curated().orders), "person-totals")
    return {
        "geographic_distribution": lambda: cu.customer_geography(customers),
        "growth_over_time": lambda: cu.customer_growth(customers, orders),
        "repeat_analysis": lambda: cu.repeat_rate(totals),
        "orders_per_customer": lambda: cu.order_frequency_stats(totals),
        "order_frequency_counts": lambda: cu.order_frequency_histogram(totals),
        "spending_overview": lambda: cu.spend_stats(totals),
        "value_segmentation": lambda: cu.value_tiers(totals),
        "frequency_segmentation": lambda: cu.frequency_tiers(totals),
    }


def product_sections(m: Market) -> Sections:
    items, products = m.order_items, m.curated().products
    return {
        "top_categories": lambda: pr.category_counts(products),
        "category_revenue": lambda: pr.category_revenue(items, products),
        "dimension_statistics": lambda: pr.dimension_stats(products),
        "outliers": lambda: pr.dimension_outliers(products),
        "top_selling_products": lambda: pr.top_products(items, products),
        "products_with_no_sales": lambda: pr.unsold_products(items, products),
        "revenue_per_product": lambda: pr.revenue_per_product(items),
        "freight_by_category": lambda: pr.freight_by_category(items, products),
        "freight_correlation": lambda: pr.freight_correlation(items, products),
        "translation_coverage": lambda: pr.translation_coverage(products),
        "missing_translations": lambda: pr.missing_translations(products),
    }


def sales_sections(m: Market) -> Sections:
    orders = stored(
        m.curated().orders.select(
            "order_id", "order_purchase_timestamp", "order_items_qty", "total_items_price", "total_freight_value", "order_value"
        ),
        "orders",
    )
    items, products, customers = m.order_items, m.curated().products, m.customers
    return {
        "revenue_totals": lambda: sa.revenue_totals(orders),
        "revenue_by_period": lambda: sa.revenue_by_period(orders),
        "revenue_growth_rate": lambda: sa.revenue_growth(orders),
        "orders_by_time": lambda: sa.orders_by_time(orders),
        "order_values": lambda: sa.order_value_stats(orders),
        "seasonality": lambda: sa.seasonality(orders),
        "spike_days": lambda: sa.daily_spikes(orders),
        "best_worst_months": lambda: sa.best_worst_months(orders),
        "best_selling_categories": lambda: sa.best_categories(items, products),
        "revenue_concentration": lambda: sa.product_concentration(items),
        "operational_metrics": lambda: sa.sales_operational(orders, customers),
    }


def payment_sections(m: Market) -> Sections:
    payments, orders, customers = stored(m.payments, "payments"), m.orders, m.customers
    return {
        "payment_methods": lambda: pa.payment_methods(payments),
        "installments": lambda: pa.installment_counts(payments),
        "installment_means": lambda: pa.installment_means(payments),
        "installment_split": lambda: pa.installment_split(payments),
        "payment_values": lambda: pa.payment_value_stats(payments),
        "multiple_payments": lambda: pa.multiple_payments(payments),
        "voucher_usage": lambda: pa.voucher_usage(payments),
        "credit_card_dominance": lambda: pa.dominant_method(payments),
        "payment_type_trends": lambda: pa.payment_trend(payments, orders),
        "business_metrics": lambda: pa.payment_business(payments, orders, customers),
    }


def delivery_sections(m: Market) -> Sections:
    orders, customers = stored(m.curated().orders, "orders"), m.customers
    return {
        "delivery_time": lambda: de.delivery_stats(orders),
        "delivery_day_distribution": lambda: de.delivery_buckets(orders),
        "delay_summary": lambda: de.delay_summary(orders),
        "delay_distribution": lambda: de.delay_buckets(orders),
        "delay_statistics": lambda: de.delay_stats(orders),
        "state_ranking": lambda: de.state_ranking(orders, customers),
        "freight_by_state": lambda: de.freight_by_state(orders, customers),
        "freight_correlation": lambda: de.freight_delivery_correlation(orders),
        "freight_distribution": lambda: de.freight_distribution(orders),
        "operational_metrics": lambda: de.delivery_operational(orders),
    }


def review_sections(m: Market) -> Sections:
    c, reviews, orders = m.curated(), m.reviews, m.orders
    base = stored(re.review_base(reviews, c.orders, m.customers, m.order_items, c.products, m.payments), "review-base")
    return {
        "score_distribution": lambda: re.score_distribution(reviews),
        "rating_trend": lambda: re.score_trend(reviews),
        "text_presence": lambda: re.text_presence(reviews),
        "text_lengths": lambda: re.text_lengths(reviews),
        "satisfaction": lambda: re.satisfaction(base),
        "correlations": lambda: re.score_correlations(base),
        "category_ratings": lambda: re.category_ratings(base),
        "operational_metrics": lambda: re.review_operational(reviews, orders),
    }


FAMILIES: dict[str, Callable[[Market], Sections]] = {
    "customers": customer_sections,
    "products": product_sections,
    "sales": sales_sections,
    "payments": payment_sections,
    "delivery": delivery_sections,
    "reviews": review_sections,
}


def sections(family: str, m: Market) -> dict[str, DataFrame]:
    return concurrently(FAMILIES[family](m))


def report(family: str, m: Market) -> DataFrame:
    """(section, row, metric, value) rows of one family."""
    return json_report(sections(family, m))


def write_report(family: str, m: Market, path: str) -> None:
    write_json_report(sections(family, m), path)
