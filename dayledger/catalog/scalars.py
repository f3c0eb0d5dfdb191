"""F01 to F23: the scalar functions, each over a whole table."""

from pyspark.sql import functions as F

from dayledger.catalog.oracle import business, raw_orders, raw_payments
from dayledger.catalog.registry import query
from dayledger.functions import moments as mo

DAY = "CAST(o_orderdate AS DATE)"
KEY = "o_orderkey"


def over_orders(name: str, sql: str, build) -> None:
    """A function of the orders table; build gets the table and returns columns by name."""
    query(name, f"SELECT o_orderkey, {sql} FROM orders")(
        lambda t: t.table("orders").select(KEY, *(c.alias(n) for n, c in build().items()))
    )


def over_lines(name: str, sql: str, build) -> None:
    """A function of line items and their orders."""
    source = "lineitem JOIN orders ON l_orderkey = o_orderkey"
    query(name, f"SELECT l_orderkey, l_linenumber, l_shipdate, {sql} FROM {source}")(
        lambda t: t.table("lineitem")
        .join(t.table("orders"), F.expr("l_orderkey = o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_shipdate", *(c.alias(n) for n, c in build().items()))
    )


query(
    "f01_trim_lower_in",
    raw_orders(
        """SELECT order_id, lower(trim(status)) AS normal, trim(status) IN ('paid', 'new') AS listed,
        status IS NULL AS missing FROM ro"""
    ),
)(
    lambda t: t.raw_orders.select(
        "order_id",
        F.lower(F.trim("status")).alias("normal"),
        F.trim("status").isin("paid", "new").alias("listed"),
        F.col("status").isNull().alias("missing"),
    )
)
over_orders(
    "f02_concat_ws_when",
    "concat_ws(' | ', CASE WHEN o_totalprice > 100000 THEN 'big' END, CASE WHEN o_orderstatus = 'F' THEN 'done' END) AS tags",
    lambda: {
        "tags": F.concat_ws(
            " | ",
            F.when(F.col("o_totalprice") > 100000, "big"),
            F.when(F.col("o_orderstatus") == "F", "done"),
        )
    },
)
query(
    "f03_forgiving_casts",
    raw_payments(
        """SELECT payment_id, payment_date, try_cast(order_id AS BIGINT) AS order_no,
        CAST(payment_date AS DATE) AS payment_day, amount_kopecks > 0 AS positive FROM rp"""
    ),
)(
    lambda t: t.raw_payments.select(
        "payment_id",
        mo.parsed("payment_date").cast("timestamp_ntz").alias("payment_date"),
        F.col("order_id").try_cast("bigint").alias("order_no"),
        mo.parsed("payment_date").cast("date").alias("payment_day"),
        (F.col("amount_kopecks") > 0).cast("boolean").alias("positive"),
    )
)
over_orders(
    "f04_date_sub", f"{DAY} - 365 AS year_before", lambda: {"year_before": F.date_sub(F.to_date("o_orderdate"), 365)}
)
query(
    "f05_as_of",
    business(
        """SELECT entity, date_diff('hour', max(loaded_at), TIMESTAMP '2001-09-01 00:30:00') AS hours_since_load
        FROM commits GROUP BY 1"""
    ),
)(lambda t: t.marts.load_freshness.select("entity", "hours_since_load"))
over_lines("f06_to_date", "CAST(l_shipdate AS DATE) AS day", lambda: {"day": mo.day_of("l_shipdate")})
over_orders(
    "f07_to_timestamp",
    f"CAST({DAY} AS TIMESTAMP) AS midnight",
    lambda: {"midnight": F.to_date("o_orderdate").cast("timestamp_ntz")},
)
query("f08_hour", "SELECT event_id, hour(ts) AS hour_of_day FROM events")(
    lambda t: t.table("events").select("event_id", F.hour("ts").alias("hour_of_day"))
)
over_orders(
    "f09_iso_weekday",
    f"isodow({DAY}) AS weekday",
    lambda: {"weekday": mo.iso_weekday(F.to_date("o_orderdate"))},
)
over_orders(
    "f10_start_of_week",
    "CAST(date_trunc('week', o_orderdate) AS DATE) AS monday",
    lambda: {"monday": mo.monday_of("o_orderdate")},
)
over_orders(
    "f11_add_weeks",
    f"{DAY} + 7 * CAST(o_orderkey % 5 AS INTEGER) AS later",
    lambda: {"later": F.date_add(F.to_date("o_orderdate"), (F.col(KEY) % 5).cast("int") * 7)},
)
over_lines(
    "f12_day_boundaries",
    "date_diff('day', o_orderdate, l_shipdate) AS days",
    lambda: {"days": mo.days_between("o_orderdate", "l_shipdate")},
)
over_lines(
    "f13_week_boundaries",
    "date_diff('day', date_trunc('week', o_orderdate), date_trunc('week', l_shipdate)) // 7 AS weeks",
    lambda: {"weeks": mo.weeks_between("o_orderdate", "l_shipdate")},
)
query(
    "f14_second_difference",
    """SELECT event_id, date_diff('second', date_trunc('day', ts), ts) AS seconds FROM events""",
)(
    lambda t: t.table("events").select(
        "event_id", mo.seconds_between(mo.day_of("ts").cast("timestamp_ntz"), "ts").alias("seconds")
    )
)
query(
    "f15_hour_boundaries",
    """SELECT event_id, date_diff('hour', ts - INTERVAL 20 MINUTE, ts) AS hours FROM events""",
)(
    lambda t: t.table("events").select(
        "event_id", mo.hours_between(F.col("ts") - F.expr("INTERVAL 20 MINUTE"), "ts").alias("hours")
    )
)
over_orders(
    "f16_date_format",
    "strftime(o_orderdate, '%Y-%m-%d') AS iso",
    lambda: {"iso": F.date_format("o_orderdate", "yyyy-MM-dd")},
)
query(
    "f17_null_handling",
    business(
        """SELECT order_id, coalesce(cancelled_at, returned_at) AS ended_at, nullif(status, 'new') AS moved,
        CASE WHEN paid_at IS NULL THEN 0 ELSE amount_kopecks END AS paid_kopecks FROM o"""
    ),
)(
    lambda t: t.orders.select(
        "order_id",
        F.coalesce("cancelled_at", "returned_at").alias("ended_at"),
        F.nullif(F.col("status"), F.lit("new")).alias("moved"),
        F.when(F.col("paid_at").isNull(), 0).otherwise(F.col("amount_kopecks")).alias("paid_kopecks"),
    )
)
over_orders(
    "f18_strings",
    """split_part(o_orderpriority, '-', 2) AS word, instr(o_orderpriority, '-') AS dash,
    lpad(CAST(o_orderkey AS VARCHAR), 19, '0') AS padded, o_orderstatus || '/' || o_orderpriority AS joined""",
    lambda: {
        "word": F.split("o_orderpriority", "-")[1],
        "dash": F.instr(F.col("o_orderpriority"), "-"),
        "padded": F.lpad(F.col(KEY).cast("string"), 19, "0"),
        "joined": F.concat("o_orderstatus", F.lit("/"), "o_orderpriority"),
    },
)
query(
    "f19_ranges",
    "SELECT l_orderkey, l_linenumber, l_shipdate, unnest(range(l_linenumber)) AS step FROM lineitem",
)(
    lambda t: t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        F.explode(F.sequence(F.lit(0), F.col("l_linenumber") - 1)).alias("step"),
    )
)
query(
    "f20_array_functions",
    business(
        """SELECT status, array_to_string(list_sort(list(method_rows), 'DESC'), ' >= ') AS trail FROM
        (SELECT status, payment_method, count(*) AS method_rows FROM p_all GROUP BY 1, 2) GROUP BY 1"""
    ),
)(
    # At most one entry per payment method in each list.
    lambda t: t.payments.groupBy("status", "payment_method")
    .agg(F.count("*").alias("n"))
    .groupBy("status")
    .agg(F.sort_array(F.collect_list("n"), asc=False).alias("n"))
    .select("status", F.array_join(F.transform("n", lambda x: x.cast("string")), " >= ").alias("trail"))
)
over_orders(
    "f21_round",
    "round(o_totalprice) AS whole, round(o_totalprice, 1) AS tenth",
    lambda: {"whole": F.round("o_totalprice"), "tenth": F.round("o_totalprice", 1)},
)
over_orders(
    "f22_casts",
    "CAST(o_orderstatus = 'F' AS TINYINT) AS flag, CAST(o_orderkey AS BIGINT) AS key64, CAST(o_orderkey % 1000 AS INTEGER) AS key32",
    lambda: {
        "flag": (F.col("o_orderstatus") == "F").cast("tinyint"),
        "key64": F.col(KEY).cast("bigint"),
        "key32": (F.col(KEY) % 1000).cast("int"),
    },
)
over_orders(
    "f23_interval_days",
    "o_orderdate - INTERVAL 34 DAY AS horizon, o_orderdate + INTERVAL 30 DAY AS window_end",
    lambda: {
        "horizon": F.col("o_orderdate") - mo.days(34),
        "window_end": F.col("o_orderdate") + mo.days(30),
    },
)
