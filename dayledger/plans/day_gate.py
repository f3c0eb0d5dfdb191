"""One day through the quality gate: customers, then orders, then payments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.fixed_values import HISTORY_LOOKBACK_DAYS
from dayledger.functions.moments import parsed
from dayledger.operators import lookups, quality
from dayledger.operators.versions import within_lookback
from dayledger.sources.layers import read_day, read_layer, write_day
from dayledger.sources.schemas import ENTITY_MOMENTS


def typed(raw: DataFrame, entity: str) -> DataFrame:
    """Text to timestamps and amounts; unreadable values become NULL for the rules to find."""
    columns = {name: parsed(name) for name in ENTITY_MOMENTS[entity]}
    if "amount_kopecks" in raw.columns:
        columns["amount_kopecks"] = F.col("amount_kopecks").try_cast("bigint")
    return raw.withColumns(columns)


@dataclass(frozen=True)
class GateOptions:
    """lookback_days bounds the history that keys are compared with. parent_lookback_days, if
    given, bounds the parents, too: children of older ones are then rejected as orphans.
    """

    lookback_days: int = HISTORY_LOOKBACK_DAYS
    strictly_before: bool = True
    parent_lookback_days: int | None = None

    def parents(self, clean: DataFrame, load_date: str) -> DataFrame:
        if self.parent_lookback_days is None:
            return clean
        return within_lookback(clean, load_date, self.parent_lookback_days)


def enriched_customers(
    customers: DataFrame, clean: DataFrame | None, load_date: str, options: GateOptions = GateOptions()
) -> DataFrame:
    copies = lookups.with_copies_in_load(customers, "customer_id")
    if clean is None:
        return copies.withColumn("in_history", F.lit(None).cast("boolean"))
    history = lookups.earlier_keys(
        clean, "customer_id", load_date, options.lookback_days, options.strictly_before
    )
    return lookups.with_presence(copies, history, "customer_id", "in_history", keys_of=customers)


def enriched_orders(orders: DataFrame, clean_customers: DataFrame) -> DataFrame:
    copies = lookups.with_copies_in_load(orders, "order_id")
    return lookups.with_presence(copies, clean_customers, "customer_id", "customer_known", keys_of=orders)


def _with_order(rows: DataFrame, payments: DataFrame, clean_orders: DataFrame) -> DataFrame:
    return lookups.with_parent_moment(
        rows, clean_orders, "order_id", "created_at", "order_known", "order_created_at", keys_of=payments
    )


def enriched_payments(payments: DataFrame, clean_orders: DataFrame) -> DataFrame:
    found = _with_order(payments, payments, clean_orders)
    return lookups.with_copies_in_load(found, "payment_id", keys_of=payments)


def tagged_customers(
    customers: DataFrame, clean: DataFrame | None, load_date: str, options: GateOptions = GateOptions()
) -> DataFrame:
    rules = quality.customer_rules()
    enriched = enriched_customers(quality.with_own_flags(customers, rules), clean, load_date, options)
    return quality.with_reasons(enriched, rules).drop("copies_in_load", "in_history")


def tagged_orders(orders: DataFrame, clean_customers: DataFrame) -> DataFrame:
    """Copies are judged first: the order's id is not needed where customers are looked up."""
    rules = quality.order_rules()
    copies = lookups.with_copies_in_load(quality.with_own_flags(orders, rules), "order_id")
    judged = quality.with_flags_of(copies, rules, "copies_in_load")
    found = lookups.with_presence(judged, clean_customers, "customer_id", "customer_known", keys_of=orders)
    return quality.with_reasons(found, rules).drop("customer_known")


def tagged_payments(payments: DataFrame, clean_orders: DataFrame) -> DataFrame:
    """Orders are looked up first: neither their ids nor moments are needed where copies are."""
    rules = quality.payment_rules()
    found = _with_order(quality.with_own_flags(payments, rules), payments, clean_orders)
    judged = quality.with_flags_of(found, rules, "order_known", "order_created_at")
    copies = lookups.with_copies_in_load(judged, "payment_id", keys_of=payments)
    return quality.with_reasons(copies, rules).drop("copies_in_load")


def _judged_customers(
    customers: DataFrame, clean: DataFrame | None, load_date: str, options: GateOptions
) -> DataFrame:
    """Customers with the flags of all rules but the one about copies; likewise below."""
    rules = quality.customer_rules()
    judged = quality.with_own_flags(customers, rules)
    if clean is None:
        return judged
    history = lookups.earlier_keys(
        clean, "customer_id", load_date, options.lookback_days, options.strictly_before
    )
    found = lookups.with_presence(judged, history, "customer_id", "in_history", keys_of=customers)
    return quality.with_flags_of(found, rules, "in_history")


def _judged_orders(orders: DataFrame, clean_customers: DataFrame) -> DataFrame:
    rules = quality.order_rules()
    own = quality.with_own_flags(orders, rules)
    found = lookups.with_presence(own, clean_customers, "customer_id", "customer_known", keys_of=orders)
    return quality.with_flags_of(found, rules, "customer_known")


def _judged_payments(payments: DataFrame, clean_orders: DataFrame) -> DataFrame:
    rules = quality.payment_rules()
    found = _with_order(quality.with_own_flags(payments, rules), payments, clean_orders)
    return quality.with_flags_of(found, rules, "order_known", "order_created_at")


def customer_volume(
    customers: DataFrame, clean: DataFrame | None, load_date: str, options: GateOptions = GateOptions()
) -> DataFrame:
    """Rows per load day that tagged_customers accepts and rejects; likewise below."""
    judged = _judged_customers(customers, clean, load_date, options)
    return quality.volume_by_key(judged, "customer_id", customers)


def order_volume(orders: DataFrame, clean_customers: DataFrame) -> DataFrame:
    return quality.volume_by_key(_judged_orders(orders, clean_customers), "order_id", orders)


def payment_volume(payments: DataFrame, clean_orders: DataFrame) -> DataFrame:
    return quality.volume_by_key(_judged_payments(payments, clean_orders), "payment_id", payments)


def customer_hits(
    customers: DataFrame, clean: DataFrame | None, load_date: str, options: GateOptions = GateOptions()
) -> DataFrame:
    """Rows per load day and code that tagged_customers rejects under it; likewise below."""
    judged = _judged_customers(customers, clean, load_date, options)
    return quality.hits_by_rule(judged, "customer_id", customers, quality.customer_rules())


def order_hits(orders: DataFrame, clean_customers: DataFrame) -> DataFrame:
    judged = _judged_orders(orders, clean_customers)
    return quality.hits_by_rule(judged, "order_id", orders, quality.order_rules())


def payment_hits(payments: DataFrame, clean_orders: DataFrame) -> DataFrame:
    judged = _judged_payments(payments, clean_orders)
    return quality.hits_by_rule(judged, "payment_id", payments, quality.payment_rules())


def write_gated(tagged: DataFrame, data_root: str, entity: str, load_date: str) -> tuple[int, int]:
    """Write both halves of a tagged day; returns (valid rows, invalid rows).

    The tagged day is the only thing kept between the two jobs: the first write fills it, the
    second reads it. What is lost with an executor is computed again. Rows are counted from
    the footers of the written files.
    """
    kept = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    halves = {"clean": quality.accepted(kept), "quarantine": quality.rejected(kept)}
    try:
        for layer, rows in halves.items():
            write_day(rows, f"{data_root}/{layer}", entity, load_date)
    finally:
        kept.unpersist()
    spark = tagged.sparkSession
    valid, invalid = (read_day(spark, f"{data_root}/{layer}", entity, load_date).count() for layer in halves)
    return valid, invalid


def gate_day(
    spark: SparkSession, data_root: str, load_date: str, options: GateOptions = GateOptions()
) -> dict[str, tuple[int, int]]:
    """raw -> clean | quarantine for the three entities, then the day's dq_metrics.

    Orders look customers up in the clean layer and payments look orders up there, so
    the entities run one after the other.
    """
    raw_root, clean_root = f"{data_root}/raw", f"{data_root}/clean"

    def raw(entity: str) -> DataFrame:
        return typed(read_day(spark, raw_root, entity, load_date), entity)

    counts = {}
    clean_customers = read_layer(spark, clean_root, "customers")
    tagged = tagged_customers(raw("customers"), clean_customers, load_date, options)
    counts["customers"] = write_gated(tagged, data_root, "customers", load_date)
    parents = options.parents(read_layer(spark, clean_root, "customers"), load_date)
    tagged = tagged_orders(raw("orders"), parents)
    counts["orders"] = write_gated(tagged, data_root, "orders", load_date)
    parents = options.parents(read_layer(spark, clean_root, "orders"), load_date)
    tagged = tagged_payments(raw("payments"), parents)
    counts["payments"] = write_gated(tagged, data_root, "payments", load_date)

    metrics = spark.createDataFrame(
        [(entity, valid, invalid, valid + invalid) for entity, (valid, invalid) in counts.items()],
        "entity string, valid_rows bigint, invalid_rows bigint, total_rows bigint",
    )
    write_day(metrics.coalesce(1), data_root, "dq_metrics", load_date)
    return counts
