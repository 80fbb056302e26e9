"""The sales transactions feed: schemas, change mapping, rules."""

from __future__ import annotations

from ..operators.changes import ChangeFeed

# Table columns, event columns, accepted statuses.
SILVER_SCHEMA = (
    "transaction_id BIGINT, customer_id INT, product_id INT, quantity INT, amount DECIMAL(10,2), "
    "transaction_date TIMESTAMP, status STRING, net_amount DECIMAL(10,2)"
)
GOLD_SCHEMA = (
    "transaction_id BIGINT, transaction_date TIMESTAMP, customer_id INT, customer_name STRING, "
    "country STRING, city STRING, product_id INT, product_name STRING, category STRING, "
    "brand STRING, quantity INT, amount DECIMAL(10,2), net_amount DECIMAL(10,2), status STRING"
)
EVENT_ROW = (
    "transaction_id BIGINT, customer_id INT, product_id INT, quantity INT, amount DOUBLE, "
    "transaction_date BIGINT, status STRING"
)
ACCEPTED_STATUSES = ("COMPLETED", "PENDING", "CANCELLED", "NEW")

TRANSACTION_KEYS = ["transaction_id"]
TRANSACTION_DAY = "transaction_date"
SEQUENCE = ["_seq_time", "_seq_id"]

# The order of changes comes from the feed: the source position where there is one.
TRANSACTION_FEED = ChangeFeed(
    row=EVENT_ROW,
    keys=TRANSACTION_KEYS,
    upsert={
        "transaction_id": "src.transaction_id",
        "customer_id": "src.customer_id",
        "product_id": "src.product_id",
        "quantity": "src.quantity",
        "amount": "try_cast(src.amount AS DECIMAL(10,2))",
        "transaction_date": "timestamp_micros(src.transaction_date)",
        "status": "src.status",
    },
    delete={"transaction_id": "src.transaction_id"},
    sequence={"_partition": "partition", "_offset": "offset"},
)

NET_AMOUNT = (
    "CASE WHEN upper(status) = 'CANCELLED' THEN CAST(0 AS DECIMAL(10,2)) ELSE amount END"
)

# Rules an upsert must meet, by the name a quarantined row is given.
TRANSACTION_RULES = {
    "amount_positive": "amount > 0",
    "quantity_positive": "quantity > 0",
    "status_present": "status IS NOT NULL",
    "status_accepted": "upper(status) IN ('" + "', '".join(ACCEPTED_STATUSES) + "')",
}
