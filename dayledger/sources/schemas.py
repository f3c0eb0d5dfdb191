"""Declared schemas; nothing is inferred, so an empty column never changes its type."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER_COLUMNS = (
    "customer_id",
    "registration_date",
    "city",
    "acquisition_channel",
    "email",
)
ORDER_MOMENTS = (
    "created_at",
    "paid_at",
    "shipped_at",
    "ready_for_pickup_at",
    "delivered_at",
    "cancelled_at",
    "returned_at",
    "refunded_at",
)
ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "created_at",
    "amount_kopecks",
    "status",
    "cancellation_reason",
    "payment_method",
    *ORDER_MOMENTS[1:],
)
PAYMENT_COLUMNS = (
    "payment_id",
    "order_id",
    "payment_date",
    "amount_kopecks",
    "payment_method",
    "status",
)
ENTITY_COLUMNS = {
    "customers": CUSTOMER_COLUMNS,
    "orders": ORDER_COLUMNS,
    "payments": PAYMENT_COLUMNS,
}
ENTITY_MOMENTS = {
    "customers": ("registration_date",),
    "orders": ORDER_MOMENTS,
    "payments": ("payment_date",),
}


def source_schema(entity: str) -> T.StructType:
    """Raw rows: text as it came, only the amount is a nullable integer."""
    return T.StructType(
        [
            T.StructField(name, T.LongType() if name == "amount_kopecks" else T.StringType())
            for name in ENTITY_COLUMNS[entity]
        ]
    )


LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("commit", T.StringType()),
        T.StructField("load_date", T.DateType()),
    ]
)
