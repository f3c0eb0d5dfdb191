"""Declarative quality rules and the gate that splits rows by them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.fixed_values import ORDER_STATUSES, PAYMENT_STATUSES, REASON_SEPARATOR
from dayledger.functions.text import blank, normalised, outside_vocabulary


@dataclass(frozen=True)
class Rule:
    """A rejection code and the condition under which a row earns it.

    Conditions follow SQL logic: an unknown (NULL) condition earns no code. looked_up names
    the column that a join has to add first, if the condition needs other rows.
    """

    code: str
    broken: Column
    looked_up: str | None = None


def not_positive(name: str) -> Column:
    return F.coalesce(F.col(name) <= 0, F.lit(True))


def customer_rules() -> list[Rule]:
    """Needs copies_in_load and in_history next to the customer columns."""
    return [
        Rule("CUSTOMER_ID_EMPTY", blank("customer_id")),
        Rule("CUSTOMER_ID_DUPLICATE_IN_LOAD", F.col("copies_in_load") > 1, looked_up="copies_in_load"),
        Rule("CUSTOMER_ID_DUPLICATE_IN_HISTORY", F.col("in_history").isNotNull(), looked_up="in_history"),
        Rule("REGISTRATION_DATE_INVALID", F.col("registration_date").isNull()),
    ]


def order_rules() -> list[Rule]:
    """Needs copies_in_load and customer_known next to the order columns."""
    status = normalised("status")
    has_reason = F.col("cancellation_reason").isNotNull()
    reason_uncalled_for = has_reason & ~status.isin("cancelled", "refunded")
    reason_missing = (status == "cancelled") & ~has_reason
    refund = F.col("refunded_at")
    refund_too_early = (refund < F.col("cancelled_at")) | (refund < F.col("returned_at"))
    return [
        Rule("ORDER_ID_EMPTY", blank("order_id")),
        Rule("ORDER_ID_DUPLICATE_IN_LOAD", F.col("copies_in_load") > 1, looked_up="copies_in_load"),
        Rule("CUSTOMER_ID_EMPTY", blank("customer_id")),
        Rule("CUSTOMER_NOT_FOUND", F.col("customer_known").isNull(), looked_up="customer_known"),
        Rule("CREATED_AT_INVALID", F.col("created_at").isNull()),
        Rule("ORDER_AMOUNT_INVALID", not_positive("amount_kopecks")),
        Rule("ORDER_STATUS_INVALID", outside_vocabulary("status", ORDER_STATUSES)),
        Rule("CANCELLATION_REASON_INCONSISTENT", reason_uncalled_for | reason_missing),
        Rule("REFUND_TIMELINE_INVALID", refund_too_early),
    ]


def payment_rules() -> list[Rule]:
    """Needs copies_in_load, order_known and order_created_at next to the payment columns."""
    return [
        Rule("PAYMENT_ID_EMPTY", blank("payment_id")),
        Rule("PAYMENT_ID_DUPLICATE_IN_LOAD", F.col("copies_in_load") > 1, looked_up="copies_in_load"),
        Rule("ORDER_ID_EMPTY", blank("order_id")),
        Rule("ORDER_NOT_FOUND", F.col("order_known").isNull(), looked_up="order_known"),
        Rule("PAYMENT_DATE_INVALID", F.col("payment_date").isNull()),
        Rule("PAYMENT_AMOUNT_INVALID", not_positive("amount_kopecks")),
        Rule("PAYMENT_STATUS_INVALID", outside_vocabulary("status", PAYMENT_STATUSES)),
        Rule("PAYMENT_BEFORE_ORDER", F.col("payment_date") < F.col("order_created_at"), looked_up="order_known"),
    ]


#: Bits of the broken rules that are judged already, by their place in the list.
BROKEN = "_own_broken"


def _bits(rules: Sequence[Rule], looked_up: str | None) -> Column:
    bits = F.lit(0)
    for place, rule in enumerate(rules):
        if rule.looked_up == looked_up:
            bits = bits + F.when(rule.broken, 1 << place).otherwise(0)
    return bits


def with_own_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rules that need no other row, as one number.

    Taken before the rows are shuffled to be looked up, so that columns which only these
    rules read don't travel, and the texts are read once.
    """
    return df.withColumn(BROKEN, _bits(rules, None))


def with_flags_of(df: DataFrame, rules: Sequence[Rule], looked_up: str, *also: str) -> DataFrame:
    """Adds the rules that a look-up decides to those of with_own_flags; its columns are dropped.

    Neither they nor what was compared with them travel to the next look-up.
    """
    return df.withColumn(BROKEN, F.col(BROKEN) + _bits(rules, looked_up)).drop(looked_up, *also)


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """dq_reason lists every broken rule's code in rule order; it is empty on a clean row.

    with_own_flags may have judged the row's own columns before, and with_flags_of the
    rules whose looked up column is not there any more.
    """

    def broken(place: int, rule: Rule) -> Column:
        judged = BROKEN in df.columns and rule.looked_up not in df.columns
        return F.col(BROKEN).bitwiseAND(F.lit(1 << place)) != 0 if judged else rule.broken

    earned = (F.when(broken(place, rule), rule.code) for place, rule in enumerate(rules))
    return df.withColumn("dq_reason", F.concat_ws(REASON_SEPARATOR, *earned)).drop(BROKEN)


def hits(df: DataFrame, rules: Sequence[Rule], code: str) -> DataFrame:
    """Only the rows that break one rule."""
    (rule,) = (r for r in rules if r.code == code)
    return df.where(rule.broken)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where("dq_reason = ''").drop("dq_reason")


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where("dq_reason <> ''").withColumn("quarantine_timestamp", F.current_timestamp())


def volume_by_entity(tagged_by_entity: dict[str, DataFrame]) -> DataFrame:
    """valid_rows, invalid_rows and total_rows per entity and load day."""
    parts = [
        df.select("load_date", F.lit(entity).alias("entity"), (F.col("dq_reason") == "").alias("_ok"))
        for entity, df in tagged_by_entity.items()
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy("load_date", "entity").agg(
        F.count_if("_ok").alias("valid_rows"),
        F.count_if(~F.col("_ok")).alias("invalid_rows"),
        F.count("*").alias("total_rows"),
    )


def hits_by_rule(judged: DataFrame, key: str, rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """What reason_hits gives for the rejected rows where only copies of the key are open.

    judged and rows are as for volume_by_key. A row with two broken rules counts under both,
    so rows don't meet their copies: these are all rows but those whose key is the only one.
    """
    (copies,) = (rule.code for rule in rules if rule.looked_up == "copies_in_load")
    keys = rows.groupBy(key).agg(F.count("*").alias("_copies"), F.min("load_date").alias("load_date"))
    single = keys.where("_copies = 1").groupBy("load_date").agg(F.count("*").alias("_rows"))
    # Rows are counted by all their rules first, so only few combinations are split.
    sets = judged.groupBy("load_date", BROKEN).agg(F.count("*").alias("_rows"))
    codes = [F.when(F.col(BROKEN).bitwiseAND(F.lit(1 << n)) != 0, rule.code) for n, rule in enumerate(rules)]
    broken = F.explode(F.array_append(F.array_compact(F.array(*codes)), F.lit(copies)))
    hits = sets.select("load_date", broken.alias("reason"), "_rows").unionByName(
        single.select("load_date", F.lit(copies).alias("reason"), (-F.col("_rows")).alias("_rows"))
    )
    return hits.groupBy("load_date", "reason").agg(F.sum("_rows").alias("quarantined_rows")).where("quarantined_rows > 0")


def volume_by_key(judged: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """valid_rows, invalid_rows and total_rows per load day where only copies of the key are open.

    judged has the flags of every other rule, rows are the same rows where they are cheaper to
    read. A valid row is the only one of its key, so rows are counted by key before the shuffle
    and are neither moved as a whole nor joined with their copies. volume_by_entity of the
    tagged rows gives the same.
    """
    clean = F.col(BROKEN) == 0
    keys = judged.groupBy(key).agg(
        F.count("*").alias("_copies"), F.count_if(clean).alias("_clean"), F.min("load_date").alias("load_date")
    )
    valid = keys.where("_copies = 1 AND _clean = 1").groupBy("load_date").agg(F.count("*").alias("valid_rows"))
    total = rows.groupBy("load_date").agg(F.count("*").alias("total_rows"))
    both = valid.withColumn("total_rows", F.lit(0).cast("bigint")).unionByName(
        total.withColumn("valid_rows", F.lit(0).cast("bigint"))
    )
    summed = both.groupBy("load_date").agg(
        F.sum("valid_rows").alias("valid_rows"), F.sum("total_rows").alias("total_rows")
    )
    invalid = (F.col("total_rows") - F.col("valid_rows")).alias("invalid_rows")
    return summed.select("load_date", "valid_rows", invalid, "total_rows")
