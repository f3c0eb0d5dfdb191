"""P, J, A, W, T, U and E: the building blocks, each over whole tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.catalog.marts import STAGE_DURATIONS
from dayledger.catalog.metrics import GMV, SPREAD
from dayledger.catalog.oracle import (
    business,
    case,
    clock,
    listed,
    raw_all,
    raw_customers,
    raw_orders,
    raw_payments,
)
from dayledger.catalog.quality import zone_free
from dayledger.catalog.registry import query
from dayledger.fixed_values import (
    CLOSED_STATUSES,
    FUNNEL_STAGES,
    ORDER_STATUSES,
    PAYMENT_METHOD_LABELS,
)
from dayledger.functions.moments import day_of, monday_of
from dayledger.functions.text import blank, labelled, normalised, outside_vocabulary
from dayledger.operators import lookups, quality, sketches
from dayledger.operators.reconcile import reason_hits
from dayledger.operators.series import calendar, trailing_mean
from dayledger.operators.versions import latest_version, within_lookback
from dayledger.plans import metrics as m
from dayledger.plans.day_gate import typed
from dayledger.sources import layers
from dayledger.sources import sketches as stored


def rows(name="rows"):
    return F.count("*").alias(name)


# --- projection and predicates ---------------------------------------------

query(
    "p01_typed_projection",
    raw_payments("SELECT payment_id, order_id, payment_date, amount_kopecks, status FROM rp"),
)(
    lambda t: zone_free(typed(t.raw_payments, "payments"), "payments").select(
        "payment_id", "order_id", "payment_date", "amount_kopecks", "status"
    )
)
query(
    "p02_blank",
    raw_customers(
        "SELECT coalesce(trim(customer_id), '') = '' AS is_blank, count(*) AS rows FROM rc GROUP BY 1"
    ),
)(lambda t: t.raw_customers.groupBy(blank("customer_id").alias("is_blank")).agg(rows()))
query(
    "p03_normalised_vocabulary",
    raw_orders(
        f"""SELECT status, lower(trim(status)) AS normal,
        status IS NULL OR trim(status) = '' OR lower(trim(status)) NOT IN ({listed(ORDER_STATUSES)}) AS outside,
        count(*) AS rows FROM ro GROUP BY 1, 2, 3"""
    ),
)(
    lambda t: t.raw_orders.groupBy(
        "status",
        normalised("status").alias("normal"),
        outside_vocabulary("status", ORDER_STATUSES).alias("outside"),
    ).agg(rows())
)
query("p04_dq_reason", raw_all("SELECT entity, dq_reason, count(*) AS rows FROM quarantine GROUP BY 1, 2"))(
    lambda t: t.tagged("customers")
    .select(F.lit("customers").alias("entity"), "dq_reason")
    .unionByName(t.tagged("orders").select(F.lit("orders").alias("entity"), "dq_reason"))
    .unionByName(t.tagged("payments").select(F.lit("payments").alias("entity"), "dq_reason"))
    .groupBy("entity", "dq_reason")
    .agg(rows())
)


@query(
    "p05_split_valid_invalid",
    raw_customers(
        """SELECT email, CASE WHEN dq_reason = '' THEN 'valid' ELSE 'invalid' END AS side,
        dq_reason <> '' AS stamped FROM tc"""
    ),
)
def _(t):
    tagged = t.tagged("customers")
    valid = quality.accepted(tagged).select("email", F.lit("valid").alias("side"), F.lit(False).alias("stamped"))
    invalid = quality.rejected(tagged).select(
        "email", F.lit("invalid").alias("side"), F.col("quarantine_timestamp").isNotNull().alias("stamped")
    )
    return valid.unionByName(invalid)


query(
    "p06_label_with_fallback",
    business(
        f"""SELECT payment_method, {case("payment_method", PAYMENT_METHOD_LABELS)} AS label, count(*) AS rows
        FROM p_all GROUP BY 1, 2"""
    ),
)(
    lambda t: t.payments.groupBy(
        "payment_method", labelled("payment_method", PAYMENT_METHOD_LABELS).alias("label")
    ).agg(rows())
)
query(
    "p07_horizon_flags",
    business("SELECT is_mature, is_payment_settled, count(*) AS rows FROM mo GROUP BY 1, 2"),
)(lambda t: t.marts.orders.groupBy("is_mature", "is_payment_settled").agg(rows()))
query(
    "p08_outcome_flags",
    business("SELECT status, attempt_succeeded, is_refunded, count(*) AS rows FROM mp GROUP BY 1, 2, 3"),
)(lambda t: t.marts.payments.groupBy("status", "attempt_succeeded", "is_refunded").agg(rows()))
query(
    "p09_milestone_predicates",
    business(
        """SELECT paid_at IS NOT NULL AS paid,
        cancelled_at IS NULL AND returned_at IS NULL AND refunded_at IS NULL AS kept, count(*) AS rows
        FROM mo GROUP BY 1, 2"""
    ),
)(lambda t: t.marts.orders.groupBy(m.paid().alias("paid"), m.kept().alias("kept")).agg(rows()))
query(
    "p10_conditional_constant",
    business(
        """SELECT CASE WHEN cancelled_at IS NOT NULL THEN 'Отмена' ELSE 'Возврат товара' END AS refund_kind,
        count(*) AS rows FROM mo WHERE refunded_at >= coalesce(cancelled_at, returned_at) GROUP BY 1"""
    ),
)(lambda t: t.marts.refund_processing_times.groupBy("refund_kind").agg(rows()))
query(
    "p11_flag_from_sibling_alias",
    clock("SELECT orders_count, has_order, count(*) AS rows FROM first_order GROUP BY 1, 2"),
)(lambda t: t.clock_marts.customer_first_order.groupBy("orders_count", "has_order").agg(rows()))
query(
    "p12_not_closed",
    business(f"SELECT order_id, status FROM o WHERE status NOT IN ({listed(CLOSED_STATUSES)})"),
)(lambda t: t.orders.where(~F.col("status").isin(*CLOSED_STATUSES)).select("order_id", "status"))
query(
    "p13_literal_rows",
    business(
        """SELECT stage, stage_order, count(*) AS rows FROM o, (VALUES ('Создано', 1), ('Оплачено', 2),
        ('Отправлено', 3), ('Готово к выдаче', 4), ('Доставлено', 5)) AS s(stage, stage_order) GROUP BY 1, 2"""
    ),
)(
    lambda t: t.orders.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(label).alias("stage"), F.lit(n).alias("stage_order"))
                    for n, (label, _) in enumerate(FUNNEL_STAGES, start=1)
                )
            )
        )
    )
    .groupBy("stage", "stage_order")
    .agg(rows())
)

# --- joins -----------------------------------------------------------------

query(
    "j01_history_presence",
    raw_customers("SELECT customer_id, email, hid IS NOT NULL AS in_history FROM ec"),
)(
    lambda t: t.enriched("customers").select(
        "customer_id", "email", F.col("in_history").isNotNull().alias("in_history")
    )
)
query(
    "j02_parent_presence",
    raw_orders("SELECT order_id, customer_id, cid IS NOT NULL AS customer_known FROM eo"),
)(
    lambda t: t.enriched("orders").select(
        "order_id", "customer_id", F.col("customer_known").isNotNull().alias("customer_known")
    )
)
query(
    "j03_parent_moment",
    raw_payments("SELECT payment_id, order_id, oat AS order_created_at FROM ep"),
)(lambda t: t.enriched("payments").select("payment_id", "order_id", "order_created_at"))
query(
    "j04_fact_with_dimension",
    business("SELECT order_id, city, acquisition_channel_ru FROM od"),
)(lambda t: t.marts.orders_with_customer_dim.select("order_id", "city", "acquisition_channel_ru"))
query(
    "j05_dimension_with_fact",
    business(
        """SELECT mc.customer_id, count(order_id) AS orders_count FROM mc
        LEFT JOIN mo ON mo.customer_id = mc.customer_id GROUP BY 1"""
    ),
)(lambda t: t.marts.customer_first_order.select("customer_id", "orders_count"))
query(
    "j06_dense_grid",
    clock("SELECT dow_label, hour_of_day, sum(orders)::BIGINT AS orders FROM hour_grid GROUP BY 1, 2"),
)(
    lambda t: t.clock_marts.orders_by_hour_dow.groupBy("dow_label", "hour_of_day").agg(
        F.sum("orders").alias("orders")
    )
)
query(
    "j07_fact_with_cohort",
    clock(
        """SELECT cohort_week_date, co.customer_id, count(*) AS orders FROM cohorts
        JOIN co ON co.customer_id = cohorts.customer_id GROUP BY 1, 2"""
    ),
)(
    lambda t: t.clock_marts.customer_order_counts.join(
        t.clock_marts.customers.select("customer_id", monday_of("registration_date").alias("cohort_week_date")),
        "customer_id",
    ).select("cohort_week_date", "customer_id", F.col("orders_count").alias("orders"))
)
query(
    "j08_payments_with_orders",
    business(
        """SELECT p.status AS payment_status, o.status AS order_status, payment_date < created_at AS early,
        count(*) AS rows FROM p JOIN o ON o.order_id = p.order_id GROUP BY 1, 2, 3"""
    ),
)(
    lambda t: lookups.join_by_key(
        t.marts.payments.select("order_id", "payment_date", F.col("status").alias("payment_status")),
        t.marts.orders.select("order_id", "created_at", F.col("status").alias("order_status")),
        "order_id",
        "inner",
    )
    .groupBy("payment_status", "order_status", (F.col("payment_date") < F.col("created_at")).alias("early"))
    .agg(rows())
)
query(
    "j09_rows_without_match",
    business("SELECT order_id FROM o WHERE order_id NOT IN (SELECT order_id FROM p_all WHERE status = 'failed')"),
)(
    lambda t: t.orders.select("order_id").join(
        t.payments.where("status = 'failed'").select("order_id").distinct(), "order_id", "left_anti"
    )
)
query(
    "j10_scalar_subquery",
    business(
        """SELECT order_id, date_diff('day', created_at, (SELECT max(created_at) FROM o)) AS days_before_last FROM o"""
    ),
)(
    lambda t: t.orders.select(
        "order_id",
        F.datediff(day_of(t.orders.agg(F.max("created_at")).scalar()), day_of("created_at")).alias(
            "days_before_last"
        ),
    )
)
query(
    "j11_membership",
    business(
        """SELECT order_id, order_id IN (SELECT order_id FROM p_all WHERE status = 'refunded') AS touched FROM o"""
    ),
)(
    # One join for both answers, so that orders are read, shuffled and sorted once.
    lambda t: t.orders.select("order_id")
    .join(
        t.payments.where("status = 'refunded'").select("order_id").distinct().withColumn("_in", F.lit(True)),
        "order_id",
        "left",
    )
    .select("order_id", F.coalesce("_in", F.lit(False)).alias("touched"))
)

# --- aggregates ------------------------------------------------------------

query("a01_count", business("SELECT status, count(*) AS rows FROM o GROUP BY status"))(
    lambda t: t.orders.groupBy("status").agg(rows())
)
query("a02_dq_metrics", raw_all("SELECT * FROM dqm"))(lambda t: t.dq_metrics)
query(
    "a03_count_if",
    business(
        """SELECT payment_method, count(*) FILTER (WHERE status = 'success') AS succeeded,
        count(*) FILTER (WHERE status = 'failed') AS failed FROM p_all GROUP BY 1"""
    ),
)(
    lambda t: t.payments.groupBy("payment_method").agg(
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
)
query(
    "a04_conditional_sum",
    business(
        """SELECT payment_method, sum(amount_kopecks)::BIGINT AS total,
        sum(CASE WHEN status = 'success' THEN amount_kopecks ELSE 0 END)::BIGINT AS succeeded
        FROM p_all GROUP BY 1"""
    ),
)(
    lambda t: t.payments.groupBy("payment_method").agg(
        F.sum("amount_kopecks").alias("total"),
        F.sum(m.kopecks_if(F.col("status") == "success")).alias("succeeded"),
    )
)
query(
    "a05_min_max",
    business(
        """SELECT status, min(created_at) AS first_at, max(created_at) AS last_at,
        min(amount_kopecks) AS least, max(amount_kopecks) AS most FROM o GROUP BY 1"""
    ),
)(
    lambda t: t.orders.groupBy("status").agg(
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
        F.min("amount_kopecks").alias("least"),
        F.max("amount_kopecks").alias("most"),
    )
)
query(
    "a06_count_distinct",
    business("SELECT status, count(DISTINCT order_id) AS orders FROM p_all GROUP BY 1"),
)(lambda t: t.payments.groupBy("status").agg(F.count_distinct("order_id").alias("orders")))
query(
    "a07_average",
    business("SELECT status, avg(amount_kopecks) AS mean_kopecks FROM o GROUP BY 1"),
)(lambda t: t.orders.groupBy("status").agg(F.avg("amount_kopecks").alias("mean_kopecks")))
query(
    "a08_exact_percentiles",
    business(
        """SELECT status, round(quantile_cont(amount_kopecks, 0.5), 3) AS p50,
        round(quantile_cont(amount_kopecks, 0.9), 3) AS p90,
        round(quantile_cont(amount_kopecks, 0.99), 3) AS p99 FROM p_all GROUP BY 1"""
    ),
)(
    lambda t: m.exact_percentiles(
        t.payments, "status", "amount_kopecks", m.PERCENTILES, slot_width=10_000
    ).select("status", *(F.round(p, 3).alias(p) for p in m.PERCENTILES))
)


@query(
    "a08_sketched_percentiles",
    business(
        """SELECT status, count(amount_kopecks) AS values_total, true AS within
        FROM p_all WHERE amount_kopecks IS NOT NULL GROUP BY 1"""
    ),
)
def _(t) -> DataFrame:
    """Sketches stored per load_date, read back, merged and held against the exact ranks."""
    root = layers.shared_folder(t.spark, "a08")
    stored.store_days(t.payments, root, "payments", "load_date", "status", "amount_kopecks")
    found = stored.read_sketches(t.spark, root, "payments")
    checked = sketches.checked_percentiles(t.payments, found, "status", "amount_kopecks", m.PERCENTILES)
    return checked.select("status", "values_total", "within")


query(
    "a09_count_of_counts",
    business(
        """SELECT n AS versions, count(*) AS payments FROM
        (SELECT payment_id, count(*) AS n FROM p_all GROUP BY 1) GROUP BY 1"""
    ),
)(
    lambda t: t.payments.groupBy("payment_id")
    .agg(F.count("*").alias("versions"))
    .groupBy("versions")
    .agg(F.count("*").alias("payments"))
)
query(
    "a10_ratio",
    business(
        """SELECT load_date, (sum(CASE WHEN status = 'success' THEN amount_kopecks ELSE 0 END)::DOUBLE
        / nullif(count(*) FILTER (WHERE status = 'success'), 0)) AS mean_success FROM p_all GROUP BY 1"""
    ),
)(
    lambda t: t.payments.groupBy("load_date").agg(
        F.try_divide(
            F.sum(m.kopecks_if(F.col("status") == "success")).cast("double"),
            F.count_if(F.col("status") == "success").cast("double"),
        ).alias("mean_success")
    )
)
query(
    "a11_ordered_collect",
    business(
        """SELECT array_to_string([a, b, c, d, e], ' >= ') AS trail, a >= b AND b >= c AND c >= d AND d >= e AS falling
        FROM (SELECT count(*) AS a, count(paid_at) AS b, count(shipped_at) AS c, count(ready_for_pickup_at) AS d,
              count(delivered_at) AS e FROM mo WHERE is_mature)"""
    ),
)(
    # Five rows, one per stage.
    lambda t: t.marts.order_funnel_stages.agg(
        F.sort_array(F.collect_list(F.struct("stage_order", "cnt"))).alias("s")
    )
    .select(F.transform("s", lambda x: x["cnt"]).alias("c"))
    .select(
        F.array_join(F.transform("c", lambda x: x.cast("string")), " >= ").alias("trail"),
        (F.col("c") == F.sort_array("c", asc=False)).alias("falling"),
    )
)
query(
    "a12_value_at_latest",
    business(
        """SELECT order_id, arg_max(status, load_date) AS status FROM
        (SELECT order_id, status, CAST(created_at AS DATE) AS load_date FROM o) GROUP BY 1"""
    ),
)(
    lambda t: t.order_versions.groupBy("order_id").agg(F.max_by("status", "load_date").alias("status"))
)
query(
    "a13_distinct_keys",
    raw_payments("SELECT DISTINCT order_id FROM rp WHERE order_id IS NOT NULL"),
)(lambda t: t.raw_payments.select("order_id").where("order_id IS NOT NULL").distinct())
query(
    "a14_weekday_daily_average",
    business(
        """SELECT CAST(isodow(created_at) AS INTEGER) AS weekday,
        count(*) / count(DISTINCT CAST(created_at AS DATE)) AS orders_per_day FROM mo GROUP BY 1"""
    ),
)(lambda t: m.weekday_daily_average(t.marts))

# --- windows ---------------------------------------------------------------

query(
    "w01_copies_in_load",
    raw_payments("SELECT payment_id, amount_kopecks, copies FROM ep"),
)(
    lambda t: lookups.with_copies_in_load(
        typed(t.raw_payments, "payments"), "payment_id", out="copies"
    ).select("payment_id", "amount_kopecks", "copies")
)
query(
    "w02_order_sequence",
    clock(
        """SELECT order_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY created_at, order_id) AS INTEGER)
        AS order_seq FROM co"""
    ),
)(lambda t: t.clock_marts.orders_with_sequence.select("order_id", "order_seq"))
query(
    "w03_trailing_mean",
    business(
        """SELECT day, payments, avg(payments) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
        AS payments_mean7 FROM (SELECT load_date AS day, count(*) AS payments FROM p_all GROUP BY 1)"""
    ),
)(
    lambda t: trailing_mean(
        t.payments.groupBy(F.col("load_date").alias("day")).agg(F.count("*").alias("payments")),
        "day",
        ["payments"],
    )
)
query("w04_latest_version", business("SELECT * FROM p"))(
    lambda t: latest_version(
        t.payments, ["payment_id"], tie_breaks=["payment_date", "amount_kopecks", "status"]
    )
)
query(
    "w05_latest_within_lookback",
    business(
        """SELECT * FROM p_all WHERE load_date BETWEEN DATE '1999-06-01' - 90 AND DATE '1999-06-01'
        QUALIFY row_number() OVER (PARTITION BY payment_id
          ORDER BY load_date DESC, payment_date DESC, amount_kopecks DESC, status DESC) = 1"""
    ),
)(
    lambda t: latest_version(
        within_lookback(t.payments, "1999-06-01", 90),
        ["payment_id"],
        tie_breaks=["payment_date", "amount_kopecks", "status"],
    )
)

# --- order and limits ------------------------------------------------------

query(
    "t01_ordered_distribution",
    business(
        """SELECT attempts, count(*) AS orders_count FROM
        (SELECT order_id, count(*) AS attempts FROM mp GROUP BY 1) GROUP BY 1 ORDER BY 1"""
    ),
)(lambda t: t.marts.payment_retries_distribution)
query(
    "t02_top10_by_metric",
    business(f"SELECT city, {GMV} AS gmv FROM od WHERE is_mature GROUP BY 1 ORDER BY gmv DESC, city LIMIT 10"),
)(lambda t: m.gmv_by_city_top10(t.marts))
query(
    "t03_row_limit",
    business(
        """SELECT customer_id, count(*) AS orders_count FROM mo GROUP BY 1
        ORDER BY orders_count DESC, customer_id LIMIT 200"""
    ),
)(
    lambda t: t.marts.customer_order_counts.orderBy(F.desc("orders_count"), "customer_id").limit(200)
)
query(
    "t04_sortable_labels",
    business(f"SELECT stage, {SPREAD} FROM ({STAGE_DURATIONS}) GROUP BY stage ORDER BY stage"),
)(lambda t: m.stage_hours(t.marts).select("stage", *(F.round(p, 6).alias(p) for p in m.PERCENTILES)))

# --- set operations --------------------------------------------------------

query(
    "u01_union_of_quarantines",
    raw_all("SELECT entity, load_date, dq_reason FROM quarantine WHERE dq_reason <> ''"),
)(
    lambda t: t.quarantine("customers")
    .select(F.lit("customers").alias("entity"), "load_date", "dq_reason")
    .unionByName(t.quarantine("orders").select(F.lit("orders").alias("entity"), "load_date", "dq_reason"))
    .unionByName(t.quarantine("payments").select(F.lit("payments").alias("entity"), "load_date", "dq_reason"))
)
query(
    "u02_stage_branches_in_one_pass",
    business(f"SELECT stage, count(*) AS rows, sum(duration_seconds)::BIGINT AS seconds FROM ({STAGE_DURATIONS}) GROUP BY 1"),
)(
    lambda t: t.marts.order_stage_durations.groupBy("stage").agg(
        rows(), F.sum("duration_seconds").alias("seconds")
    )
)
query(
    "u03_concat_batches",
    business("SELECT status, count(*) AS rows FROM p_all GROUP BY 1"),
)(
    # Batches by status, one of them empty.
    lambda t: t.payments.where("status = 'success'")
    .unionByName(t.payments.where("status = 'failed'"))
    .unionByName(t.payments.where("status = 'refunded'"))
    .unionByName(t.payments.where("status = 'nowhere'"))
    .groupBy("status")
    .agg(rows())
)

# --- generators ------------------------------------------------------------

query(
    "e01_single_reasons",
    raw_all("SELECT entity, load_date, code AS reason, count(*) AS quarantined_rows FROM split_reasons GROUP BY 1, 2, 3"),
)(
    lambda t: reduce(
        DataFrame.unionByName,
        (
            reason_hits(t.quarantine(entity)).withColumn("entity", F.lit(entity))
            for entity in ("customers", "orders", "payments")
        ),
    )
)
query(
    "e02_hour_axis",
    clock(
        """SELECT dow_label, CAST(hour_of_day AS INTEGER) AS hour_of_day, days FROM day_axis CROSS JOIN hour_axis"""
    ),
)(
    lambda t: t.clock_marts.orders_by_hour_dow.select("dow_label", "hour_of_day", "days").distinct()
)
query(
    "e03_calendar",
    """SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
    INTERVAL 1 DAY)) AS DATE) AS day""",
)(lambda t: calendar(t.table("orders"), "o_orderdate"))
query("e04_week_axis", clock("SELECT CAST(weeks_since_signup AS INTEGER) AS weeks_since_signup FROM week_axis"))(
    lambda t: t.clock_marts.customer_cohort_retention.select("weeks_since_signup").distinct()
)
