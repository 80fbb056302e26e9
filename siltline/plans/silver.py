"""Cleaned tables from raw ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.changes import with_failed_rule
from ..operators.latest import latest_per_key
from .feeds import NET_AMOUNT, TRANSACTION_KEYS, TRANSACTION_RULES

# Columns of the cleaned dimensions and their types.
CUSTOMER_TYPES = {
    "customer_id": "int", "first_name": "string", "last_name": "string", "full_name": "string",
    "birth_date": "date", "gender": "string", "email": "string", "phone": "string",
    "country": "string", "city": "string", "address": "string", "registration_date": "timestamp",
    "customer_segment": "string", "is_active": "boolean", "created_at": "timestamp",
    "updated_at": "timestamp",
}
PRODUCT_TYPES = {
    "product_id": "int", "product_name": "string", "category": "string", "brand": "string",
    "color": "string", "size": "string", "unit_price": "decimal(10,2)",
    "cost_price": "decimal(10,2)", "unit_of_measure": "string", "is_active": "boolean",
    "created_at": "timestamp", "updated_at": "timestamp",
}


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The named columns, cast; a value that does not fit its type is an error."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in types.items()])


def clean_dimension(
    raw: DataFrame, key: str, types: Mapping[str, str],
    newest: Sequence[str | Column] = ("updated_at",),
) -> DataFrame:
    """Newest row per key, typed, without rows that lack the key."""
    return typed(latest_per_key(raw.where(F.col(key).isNotNull()), [key], newest), types)


def customers(raw: DataFrame, newest: Sequence[str | Column] = ("updated_at",)) -> DataFrame:
    return clean_dimension(raw, "customer_id", CUSTOMER_TYPES, newest)


def products(raw: DataFrame, newest: Sequence[str | Column] = ("updated_at",)) -> DataFrame:
    return clean_dimension(raw, "product_id", PRODUCT_TYPES, newest)


def with_net_amount(transactions: DataFrame) -> DataFrame:
    """Cancelled transactions count with amount 0."""
    return transactions.withColumn("net_amount", F.expr(NET_AMOUNT))


def transactions(
    raw: DataFrame, newest: Sequence[str | Column], rules: Mapping[str, str] = TRANSACTION_RULES
) -> DataFrame:
    """Newest row per transaction that meets the rules, with its net amount."""
    latest = latest_per_key(raw, TRANSACTION_KEYS, newest).dropna("any", subset=TRANSACTION_KEYS)
    return with_net_amount(
        with_failed_rule(latest, rules).where("failed_rule IS NULL").drop("failed_rule")
    )


def transaction_quarantine(
    raw: DataFrame, newest: Sequence[str | Column], rules: Mapping[str, str] = TRANSACTION_RULES
) -> DataFrame:
    """Newest rows that fail, with the name of the first rule they fail."""
    latest = latest_per_key(raw, TRANSACTION_KEYS, newest).dropna("any", subset=TRANSACTION_KEYS)
    return with_failed_rule(latest, rules).where("failed_rule IS NOT NULL")
