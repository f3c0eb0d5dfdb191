"""V01 to V17, each as one row (check_name, ok, detail)."""

from dayledger.catalog.marts import sparse
from dayledger.catalog.oracle import ENTITIES, business, clock, orders_part, over, payments_part, raw_all
from dayledger.catalog.registry import query
from dayledger.plans import invariants as v


def _verdict(check, ok: str, detail: str, source: str) -> str:
    return f"SELECT '{check.__name__}' AS check_name, {ok} AS ok, {detail} AS detail FROM ({source})"


def _none(check, bad: str, source: str) -> str:
    counted = f"SELECT count(*) FILTER (WHERE {bad}) AS n FROM {source}"
    return _verdict(check, "n = 0", "CAST(n AS VARCHAR)", counted)


def _pair(check, sign: str, detail: str, a: str, b: str) -> str:
    return _verdict(check, f"a {sign} b", detail, f"SELECT ({a})::BIGINT AS a, ({b})::BIGINT AS b")


VS = "a || ' vs ' || b"
PAID = "SELECT coalesce(sum(amount_kopecks), 0) FROM mo WHERE is_mature AND paid_at IS NOT NULL"
KEPT = " AND cancelled_at IS NULL AND returned_at IS NULL AND refunded_at IS NULL"

query(
    "v01_one_row_per_order",
    business(
        _pair(v.one_row_per_order, "=", VS, "SELECT count(*) FROM mo", "SELECT count(DISTINCT order_id) FROM mo")
    ),
)(lambda t: v.one_row_per_order(t.version_marts))
query(
    "v02_conversion_below_one",
    sparse(
        _pair(
            v.conversion_below_one,
            "<",
            "a || ' of ' || b",
            "SELECT count(*) FROM sfo WHERE is_mature AND has_order",
            "SELECT count(*) FROM sfo WHERE is_mature",
        )
    ),
)(lambda t: v.conversion_below_one(t.sparse_marts))
query(
    "v03_flag_agrees_with_date",
    sparse(_none(v.flag_agrees_with_date, "has_order <> (first_order_at IS NOT NULL)", "sfo")),
)(lambda t: v.flag_agrees_with_date(t.sparse_marts))
query(
    "v04_window_within_history",
    sparse(
        _pair(
            v.window_within_history,
            "<=",
            "a || ' <= ' || b",
            "SELECT count(*) FROM sfo WHERE is_mature AND converted_within_window",
            "SELECT count(*) FROM sfo WHERE is_mature AND has_order",
        )
    ),
)(lambda t: v.window_within_history(t.sparse_marts))
query(
    "v05_no_epoch_first_order",
    sparse(_none(v.no_epoch_first_order, "CAST(first_order_at AS DATE) = DATE '1970-01-01'", "sfo")),
)(lambda t: v.no_epoch_first_order(t.sparse_marts))
query(
    "v06_join_keeps_orders",
    business(_pair(v.join_keeps_orders, "=", VS, "SELECT count(*) FROM od", "SELECT count(*) FROM mo")),
)(lambda t: v.join_keeps_orders(t.marts))
query("v07_every_order_has_city", business(_none(v.every_order_has_city, "city = ''", "od")))(
    lambda t: v.every_order_has_city(t.marts)
)
query(
    "v08_net_below_paid", business(_pair(v.net_below_paid, "<", "b || ' -> ' || a", PAID + KEPT, PAID))
)(lambda t: v.net_below_paid(t.marts))
query(
    "v09_refund_keeps_success",
    business(
        _pair(
            v.refund_keeps_success,
            "=",
            VS,
            "SELECT count(*) FROM mp WHERE attempt_succeeded",
            "SELECT count(*) FROM mp WHERE status IN ('success', 'refunded')",
        )
    ),
)(lambda t: v.refund_keeps_success(t.marts))
ATTEMPTS = "SELECT count(*) AS attempts FROM mp GROUP BY order_id"
query(
    "v10_attempts_cover_orders",
    business(
        _pair(
            v.attempts_cover_orders,
            "=",
            VS,
            f"SELECT count(*) FROM ({ATTEMPTS})",
            "SELECT count(DISTINCT order_id) FROM mp",
        )
    ),
)(lambda t: v.attempts_cover_orders(t.marts))
query(
    "v11_at_least_one_attempt",
    business(
        _verdict(
            v.at_least_one_attempt,
            "n >= 1",
            "CAST(n AS VARCHAR)",
            f"SELECT min(attempts) AS n FROM ({ATTEMPTS})",
        )
    ),
)(lambda t: v.at_least_one_attempt(t.marts))
query(
    "v12_funnel_never_grows",
    business(
        _verdict(
            v.funnel_never_grows,
            "a >= b AND b >= c AND c >= d AND d >= e",
            "concat_ws(' >= ', a, b, c, d, e)",
            """SELECT count(*) AS a, count(paid_at) AS b, count(shipped_at) AS c,
               count(ready_for_pickup_at) AS d, count(delivered_at) AS e FROM mo WHERE is_mature""",
        )
    ),
)(lambda t: v.funnel_never_grows(t.marts))
query(
    "v13_payment_not_before_order",
    over(
        _none(
            v.payment_not_before_order,
            "payment_date < created_at",
            """(SELECT payment_date, o.created_at FROM tp
                JOIN o ON CAST(o.order_id AS VARCHAR) = tp.order_id WHERE dq_reason = '')""",
        ),
        ENTITIES,
        payments_part(),
    ),
)(lambda t: v.payment_not_before_order(t.gated_marts))
query(
    "v14_grid_keeps_orders",
    clock(
        _pair(v.grid_keeps_orders, "=", VS, "SELECT sum(orders) FROM hour_grid", "SELECT count(*) FROM co")
    ),
)(lambda t: v.grid_keeps_orders(t.clock_marts))
query(
    "v15_retention_grid_whole",
    clock(
        _verdict(
            v.retention_grid_whole,
            "n = 0 AND lo = 0",
            "lo || '..' || hi || ', ' || n",
            """SELECT count(*) FILTER (WHERE retention_rate > 1) AS n, min(weeks_since_signup) AS lo,
               max(weeks_since_signup) AS hi FROM cohort_grid""",
        )
    ),
)(lambda t: v.retention_grid_whole(t.clock_marts))
query(
    "v16_open_orders_explained",
    over(
        _none(
            v.open_orders_explained,
            """is_mature AND status NOT IN ('delivered', 'cancelled', 'refunded') AND NOT EXISTS
               (SELECT 1 FROM tor WHERE tor.dq_reason <> '' AND tor.order_id = CAST(m.order_id AS VARCHAR))""",
            "mo AS m",
        ),
        ENTITIES,
        orders_part(),
    ),
)(lambda t: v.open_orders_explained(t.gated_marts))
query(
    "v17_reasons_are_single",
    raw_all(_none(v.reasons_are_single, "contains(reason, ' | ')", "reasons")),
)(lambda t: v.reasons_are_single(t.marts))
