"""D01 to D22: single rules, then whole-entity gates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.catalog.oracle import raw_customers, raw_orders, raw_payments
from dayledger.catalog.registry import query
from dayledger.operators import quality
from dayledger.sources.schemas import ENTITY_COLUMNS, ENTITY_MOMENTS

IDENTITY = {
    "customers": ("customer_id", "email", "load_date"),
    "orders": ("order_id", "customer_id", "amount_kopecks", "status"),
    "payments": ("payment_id", "order_id", "amount_kopecks", "status"),
}
SQL = {"customers": raw_customers, "orders": raw_orders, "payments": raw_payments}
CODES_VIEW = {"customers": "codes_c", "orders": "codes_o", "payments": "codes_p"}
TAGGED_VIEW = {"customers": "tc", "orders": "tor", "payments": "tp"}
RULES = {
    "customers": quality.customer_rules,
    "orders": quality.order_rules,
    "payments": quality.payment_rules,
}
NUMBERED = (
    ("d01", "customers", "CUSTOMER_ID_EMPTY"),
    ("d02", "customers", "CUSTOMER_ID_DUPLICATE_IN_LOAD"),
    ("d03", "customers", "CUSTOMER_ID_DUPLICATE_IN_HISTORY"),
    ("d04", "customers", "REGISTRATION_DATE_INVALID"),
    ("d05", "orders", "ORDER_ID_EMPTY"),
    ("d06", "orders", "ORDER_ID_DUPLICATE_IN_LOAD"),
    ("d07", "orders", "CUSTOMER_ID_EMPTY"),
    ("d08", "orders", "CUSTOMER_NOT_FOUND"),
    ("d09", "orders", "CREATED_AT_INVALID"),
    ("d10", "orders", "ORDER_AMOUNT_INVALID"),
    ("d11", "orders", "ORDER_STATUS_INVALID"),
    ("d12", "orders", "CANCELLATION_REASON_INCONSISTENT"),
    ("d13", "orders", "REFUND_TIMELINE_INVALID"),
    ("d14", "payments", "PAYMENT_ID_EMPTY"),
    ("d15", "payments", "PAYMENT_ID_DUPLICATE_IN_LOAD"),
    ("d16", "payments", "ORDER_ID_EMPTY"),
    ("d17", "payments", "ORDER_NOT_FOUND"),
    ("d18", "payments", "PAYMENT_DATE_INVALID"),
    ("d19", "payments", "PAYMENT_AMOUNT_INVALID"),
    ("d20", "payments", "PAYMENT_STATUS_INVALID"),
    ("d21", "payments", "PAYMENT_BEFORE_ORDER"),
)


def zone_free(df: DataFrame, entity: str) -> DataFrame:
    """Parsed moments without a time zone, the way the comparison engine has them."""
    return df.withColumns({m: F.col(m).cast("timestamp_ntz") for m in ENTITY_MOMENTS[entity]})


def _register_rule(number: str, entity: str, code: str) -> None:
    columns = ", ".join(IDENTITY[entity])
    sql = SQL[entity](f"SELECT {columns} FROM {CODES_VIEW[entity]} WHERE {number} IS NOT NULL")

    def rows(t):
        return quality.hits(t.enriched(entity), RULES[entity](), code).select(*IDENTITY[entity])

    query(f"{number}_{code.lower()}", sql)(rows)


for _number, _entity, _code in NUMBERED:
    _register_rule(_number, _entity, _code)


def _register_gate(entity: str) -> None:
    columns = (*ENTITY_COLUMNS[entity], "load_date", "dq_reason")
    sql = SQL[entity](f"SELECT {', '.join(columns)} FROM {TAGGED_VIEW[entity]}")
    query(f"d22_gate_{entity}", sql)(
        lambda t: zone_free(t.tagged(entity), entity).select(*columns)
    )


for _entity in ENTITY_COLUMNS:
    _register_gate(_entity)
