"""Metric tables and the wide fact, from cleaned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup
from ..operators.series import date_spine
from ..sources.staging import staged
from ..streaming.upkeep import Metric


def _average_value() -> Column:
    """Net amount per transaction, to cents."""
    return F.round(F.try_divide(F.sum("net_amount"), F.count("*")), 2)


def daily_summary(transactions: DataFrame) -> DataFrame:
    status = F.upper("status")
    return transactions.groupBy(F.to_date("transaction_date").alias("metric_date")).agg(
        F.count("*").alias("total_transactions"),
        F.sum("net_amount").alias("total_revenue"),
        F.sum("quantity").alias("total_quantity"),
        F.count_if(status == "CANCELLED").alias("cancelled_count"),
        F.count_if(status == "PENDING").alias("pending_count"),
        _average_value().alias("avg_order_value"),
    )


def dense_daily_summary(transactions: DataFrame) -> DataFrame:
    """Daily summary with a row of zeros for days without transactions, first to last day."""
    daily = staged(daily_summary(transactions), "daily")  # one pass over the transactions
    ends = daily.agg(
        F.min("metric_date").alias("first"), F.date_add(F.max("metric_date"), 1).alias("end")
    ).first()
    if ends.first is None:
        return daily
    spine = date_spine(transactions.sparkSession, "day", ends.first, ends.end)
    days = spine.select(F.to_date("date_day").alias("metric_date"))
    filled = days.join(daily, "metric_date", "left")
    zero = [c for c in daily.columns if c not in ("metric_date", "avg_order_value")]
    return filled.fillna(0, subset=zero)


def customer_metrics(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per customer with transactions. The join comes after the grouping."""
    totals = transactions.groupBy("customer_id").agg(
        F.min("transaction_date").alias("first_purchase_date"),
        F.max("transaction_date").alias("last_purchase_date"),
        F.count("*").alias("total_orders"),
        F.sum("net_amount").alias("total_spent"),
        _average_value().alias("avg_order_value"),
    )
    return with_customer(totals, customers)


def product_performance(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """One row per product with transactions. The join comes after the grouping."""
    totals = transactions.groupBy("product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.count("*").alias("total_transactions"),
        F.sum("net_amount").alias("total_revenue"),
    )
    return with_product(totals, products)


def fact_transactions(
    transactions: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Transactions with the names of their customer and product.

    ``transactions`` has one row per key and the dimensions have one row per theirs, so the result
    has one row per transaction without another pass.
    """
    located = lookup(
        transactions.where("transaction_id IS NOT NULL"),
        customers.select("customer_id", F.col("full_name").alias("customer_name"), "country", "city"),
        "customer_id",
    )
    named = lookup(
        located, products.select("product_id", "product_name", "category", "brand"),
        "product_id", keys_of=transactions,
    )
    return named.select(
        "transaction_id", "transaction_date", "customer_id", "customer_name", "country", "city",
        "product_id", "product_name", "category", "brand", "quantity", "amount", "net_amount",
        "status",
    )


# The metric tables as totals that can be kept by deltas, and how they are read.
REVENUE = "CAST(total_revenue AS DECIMAL(20,2))"
DAILY = Metric(
    {"metric_date": "to_date(transaction_date)"},
    {"total_revenue": "net_amount", "total_quantity": "quantity",
     "cancelled": "CASE WHEN upper(status) = 'CANCELLED' THEN 1 END",
     "pending": "CASE WHEN upper(status) = 'PENDING' THEN 1 END"},
)
DAILY_COLUMNS = {
    "metric_date": "metric_date", "total_transactions": "n_rows", "total_revenue": REVENUE,
    "total_quantity": "total_quantity", "cancelled_count": "coalesce(cancelled, 0L)",
    "pending_count": "coalesce(pending, 0L)", "avg_order_value": f"round(try_divide({REVENUE}, n_rows), 2)",
}
SPENT = "CAST(total_spent AS DECIMAL(20,2))"
CUSTOMER = Metric(
    {"customer_id": "customer_id"}, {"total_spent": "net_amount"},
    {"first_purchase_date": "transaction_date"}, {"last_purchase_date": "transaction_date"},
)
CUSTOMER_COLUMNS = {
    "customer_id": "customer_id", "first_purchase_date": "first_purchase_date",
    "last_purchase_date": "last_purchase_date", "total_orders": "n_rows", "total_spent": SPENT,
    "avg_order_value": f"round(try_divide({SPENT}, n_rows), 2)",
}
PRODUCT = Metric(
    {"product_id": "product_id"}, {"total_quantity_sold": "quantity", "total_revenue": "net_amount"}
)
PRODUCT_COLUMNS = {
    "product_id": "product_id", "total_quantity_sold": "total_quantity_sold",
    "total_transactions": "n_rows", "total_revenue": REVENUE,
}


def with_customer(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """Totals per customer with the customer's names, as :func:`customer_metrics` has them."""
    names = ["full_name", "country", "city", "customer_segment"]
    return totals.join(customers.select("customer_id", *names), "customer_id", "left").select(
        "customer_id", *names, *totals.columns[1:]
    )


def with_product(totals: DataFrame, products: DataFrame) -> DataFrame:
    """Totals per product with the product's names, as :func:`product_performance` has them."""
    names = ["product_name", "category", "brand", "color", "unit_price"]
    return totals.join(products.select("product_id", *names), "product_id", "left").select(
        "product_id", *names, *totals.columns[1:]
    )
