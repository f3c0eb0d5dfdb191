"""S01 to S17: sources, day partitions, the ledger and views, as write-and-read-back queries.

Files go to a new folder under the cluster's shared one; each query writes whole tables.
"""

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.catalog.oracle import business, one_day, raw_payments, registered
from dayledger.catalog.quality import zone_free
from dayledger.catalog.registry import query
from dayledger.operators.versions import latest_version, within_lookback
from dayledger.plans.day_gate import gate_day
from dayledger.session import side_by_side
from dayledger.sources import layers, ledger
from dayledger.sources.driver_tables import LOAD_DATE, DriverTables
from dayledger.sources.schemas import ENTITY_COLUMNS
from dayledger.sources.warehouse import warehouse_marts

PAYMENT_COLUMNS = ENTITY_COLUMNS["payments"]
CSV_PATH = f"load_date={LOAD_DATE}"


#: Appended to a text of every exported row: quotes, a comma and a line break.
ODD_TEXT = ' "so ""called"", \nnew line'


def _export_csv(t: DriverTables, root: str, entity: str) -> str:
    """What a source system would send: one CSV export for the day."""
    path = f"{root}/source/{entity}/{CSV_PATH}/{entity}.csv"
    raw = getattr(t, f"raw_{entity}").select(*ENTITY_COLUMNS[entity])
    free_text = {"customers": "email", "payments": "payment_method"}.get(entity)
    if free_text is not None:
        raw = raw.withColumn(free_text, F.concat(free_text, F.lit(ODD_TEXT)))
    (
        raw.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


RAW_PAYMENT_TEXT = """SELECT payment_id, order_id,
  coalesce(strftime(payment_date, '%Y-%m-%d %H:%M:%S'), 'n/a') AS payment_date,
  amount_kopecks, payment_method, status{extra} FROM rp"""
ODD_PAYMENTS = f"""SELECT * REPLACE (payment_method || replace('{ODD_TEXT}', chr(92) || 'n', chr(10)) AS payment_method)
  FROM ({RAW_PAYMENT_TEXT.format(extra="")})"""


@query("s01_read_source_csv", raw_payments(ODD_PAYMENTS))
def _(t: DriverTables) -> DataFrame:
    path = _export_csv(t, layers.shared_folder(t.spark, "s01"), "payments")
    return layers.read_source_csv(t.spark, path, "payments")


@query(
    "s02_empty_source_rejected",
    "SELECT o_orderstatus AS status, count(*) AS rows, false AS accepted_without_rows FROM orders GROUP BY 1",
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s02")
    orders = t.table("orders").select(F.col("o_orderkey").cast("string").alias("order_id"))
    headed = orders.select("order_id", *(F.lit(None).cast("string").alias(c) for c in ENTITY_COLUMNS["orders"][1:]))
    headed.where("order_id IS NULL").write.option("header", True).csv(f"{root}/orders.csv")
    try:
        layers.read_source_csv(t.spark, f"{root}/orders.csv", "orders")
        accepted = True
    except ValueError:
        accepted = False
    counted = t.table("orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("rows"))
    return counted.withColumn("accepted_without_rows", F.lit(accepted))


@query(
    "s03_write_raw_once",
    raw_payments(f"SELECT *, true AS second_write_refused FROM ({RAW_PAYMENT_TEXT.format(extra='')})"),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s03")
    raw = t.raw_payments.select(*PAYMENT_COLUMNS)
    layers.write_raw(raw, root, "payments", LOAD_DATE)
    try:
        layers.write_raw(raw, root, "payments", LOAD_DATE)
        refused = False
    except FileExistsError:
        refused = True
    stored = layers.read_day(t.spark, root, "payments", LOAD_DATE).drop("load_date")
    return stored.withColumn("second_write_refused", F.lit(refused))


@query(
    "s04_ingest_manifest",
    one_day(
        f"""SELECT load_date, 'csv' AS source_format, 'parquet' AS target_format, entity, rows FROM (
        SELECT DATE '{LOAD_DATE}' AS load_date, entity, count(*) AS rows FROM quarantine GROUP BY entity)"""
    ),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s04")
    for entity in ENTITY_COLUMNS:
        _export_csv(t, root, entity)
    layers.ingest_day(t.spark, root, LOAD_DATE)
    manifest = t.spark.read.schema(
        "source_format string, target_format string, entity string, rows bigint"
    ).json(f"{root}/raw/_manifests/load_date={LOAD_DATE}")
    return manifest.withColumn("load_date", F.to_date(F.lit(LOAD_DATE)))


@query(
    "s05_read_day",
    raw_payments(RAW_PAYMENT_TEXT.format(extra=f", DATE '{LOAD_DATE}' AS load_date")),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s05")
    layers.write_raw(t.raw_payments.select(*PAYMENT_COLUMNS), root, "payments", LOAD_DATE)
    return layers.read_day(t.spark, root, "payments", LOAD_DATE)


def _write_by_year(t: DriverTables, root: str) -> None:
    """Payments loaded in yearly batches, each under the first day of its year."""
    yearly = t.payments.withColumn("load_date", F.trunc("load_date", "year"))
    # One job for all batches: rows go to the writer of their own day.
    yearly.write.partitionBy("load_date").mode("overwrite").parquet(f"{root}/payments")


YEARLY = """SELECT payment_id, order_id, payment_date, amount_kopecks, payment_method, status,
  CAST(date_trunc('year', load_date) AS DATE) AS load_date FROM p_all"""


@query("s06_read_layer", business(YEARLY))
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s06")
    _write_by_year(t, root)
    return layers.read_layer(t.spark, root, "payments")


@query(
    "s07_replace_one_day",
    business(
        f"""SELECT load_date, status, count(*) AS rows FROM ({YEARLY})
        WHERE load_date <> DATE '1997-01-01' OR status = 'success' GROUP BY 1, 2"""
    ),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s07")
    _write_by_year(t, root)
    year = t.payments.where(F.year("load_date") == 1997)
    layers.write_day(year.where("status = 'success'"), root, "payments", "1997-01-01")
    return (
        layers.read_layer(t.spark, root, "payments")
        .groupBy("load_date", "status")
        .agg(F.count("*").alias("rows"))
    )


def _gated_day(t: DriverTables, root: str) -> dict:
    def write(entity: str) -> None:
        raw = getattr(t, f"raw_{entity}").select(*ENTITY_COLUMNS[entity])
        layers.write_raw(raw, f"{root}/raw", entity, LOAD_DATE)

    side_by_side(t.spark, [partial(write, entity) for entity in ENTITY_COLUMNS])
    return gate_day(t.spark, root, LOAD_DATE)


@query(
    "s08_write_clean_and_quarantine",
    one_day("SELECT entity, dq_reason, count(*) AS rows FROM quarantine GROUP BY 1, 2"),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s08")
    _gated_day(t, root)
    parts = []
    for entity in ENTITY_COLUMNS:
        clean = layers.read_day(t.spark, f"{root}/clean", entity, LOAD_DATE)
        rejected = layers.read_day(t.spark, f"{root}/quarantine", entity, LOAD_DATE)
        parts.append(clean.select(F.lit(entity).alias("entity"), F.lit("").alias("dq_reason")))
        parts.append(rejected.select(F.lit(entity).alias("entity"), "dq_reason"))
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy("entity", "dq_reason").agg(F.count("*").alias("rows"))


@query(
    "s09_load_warehouse",
    one_day(
        """SELECT payment_id, order_id, payment_date, amount_kopecks, payment_method, status
        FROM tp WHERE dq_reason = ''"""
    ),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s09")
    _gated_day(t, root)
    ledger.load_day(t.spark, root, f"{root}/warehouse", LOAD_DATE)
    loaded = layers.read_layer(t.spark, f"{root}/warehouse", "payments").drop("load_date")
    return zone_free(loaded, "payments")


TABLE_COUNTS = """SELECT entity AS "table", count(*) AS rows FROM quarantine WHERE dq_reason = '' GROUP BY 1
  UNION ALL SELECT 'quarantine_' || entity, count(*) FROM quarantine WHERE dq_reason <> '' GROUP BY 1
  UNION ALL SELECT 'dq_metrics', 3"""


@query(
    "s10_clear_day",
    one_day(f"""SELECT "table", 0::BIGINT AS rows FROM ({TABLE_COUNTS}) UNION ALL SELECT '_load_commits', 0"""),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s10")
    _gated_day(t, root)
    ledger.load_day(t.spark, root, f"{root}/warehouse", LOAD_DATE)
    ledger.clear_load(t.spark, f"{root}/warehouse", LOAD_DATE)
    counts = None
    for table in (ledger.LEDGER, *ledger.DATA_TABLES):
        left = layers.read_day(t.spark, f"{root}/warehouse", table, LOAD_DATE)
        one = left.agg(F.count("*").alias("rows")).withColumn("table", F.lit(table))
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    "s11_skip_committed_day",
    one_day(
        """SELECT entity, count(*) AS rows, true AS first_loaded, false AS again_loaded, true AS forced_loaded
        FROM quarantine WHERE dq_reason = '' GROUP BY entity"""
    ),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s11")
    _gated_day(t, root)
    warehouse = f"{root}/warehouse"
    outcomes = {
        "first_loaded": ledger.load_day(t.spark, root, warehouse, LOAD_DATE),
        "again_loaded": ledger.load_day(t.spark, root, warehouse, LOAD_DATE),
        "forced_loaded": ledger.load_day(t.spark, root, warehouse, LOAD_DATE, force=True),
    }
    loaded = ledger.read_ledger(t.spark, warehouse).where(F.col("entity").isin(*ENTITY_COLUMNS))
    flags = (F.lit(done).alias(name) for name, done in outcomes.items())
    return loaded.select("entity", "rows", *flags)


#: Versions up to the first day are loaded with it, all later ones with the second.
LOADS = ("1995-06-17", "1999-12-31")


def _write_loads(t: DriverTables, root: str) -> None:
    """Two processed days: of each key the newest of its versions that fall to the day."""
    first = F.col("load_date") <= F.to_date(F.lit(LOADS[0]))
    versions = {
        "customers": (t.customer_versions, ["customer_id"], []),
        "orders": (t.order_versions, ["order_id"], []),
        "payments": (t.payments, ["payment_id"], ["payment_date", "amount_kopecks", "status"]),
    }
    for day, part in zip(LOADS, (first, ~first), strict=True):
        for entity, (rows, keys, ties) in versions.items():
            newest = latest_version(rows.where(part), keys, tie_breaks=ties).drop("load_date")
            layers.write_day(newest, f"{root}/clean", entity, day)
            rejected = newest.where("false").withColumn("dq_reason", F.lit(""))
            layers.write_day(rejected, f"{root}/quarantine", entity, day)
        metrics = t.spark.createDataFrame([], "entity string, valid_rows bigint, invalid_rows bigint, total_rows bigint")
        layers.write_day(metrics, root, "dq_metrics", day)


@query(
    "w04_maintained_after_reloads",
    business(
        f"""SELECT 'customers' AS entity, CAST(customer_id AS VARCHAR) AS id, city AS state, registration_date AS at
        FROM (SELECT customer_id, registration_date, city, load_date FROM c UNION ALL
              SELECT s_suppkey, {registered("s_suppkey")}, n_name, CAST({registered("s_suppkey")} AS DATE) + 1
              FROM supplier JOIN nation ON s_nationkey = n_nationkey)
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY load_date DESC) = 1
        UNION ALL SELECT 'orders', CAST(order_id AS VARCHAR), status, created_at FROM o
        UNION ALL SELECT 'payments', payment_id, status, payment_date FROM p"""
    ),
)
def _(t: DriverTables) -> DataFrame:
    """The second day is loaded, then the first, then both again by force, each keeping the state."""
    root = layers.shared_folder(t.spark, "w04")
    warehouse = f"{root}/warehouse"
    _write_loads(t, root)
    for day, force in ((LOADS[1], False), (LOADS[0], False), (LOADS[1], True), (LOADS[0], True)):
        ledger.load_day(t.spark, root, warehouse, day, force, keep_current=True)
    marts = warehouse_marts(t.spark, warehouse, current=True)
    if not marts.current:
        raise RuntimeError("the loads kept no state")
    parts = [
        marts.tables[entity].select(
            F.lit(entity).alias("entity"), F.col(key).cast("string").alias("id"), F.col(state).alias("state"),
            F.col(at).cast("timestamp_ntz").alias("at"),
        )
        for entity, key, state, at in (
            ("customers", "customer_id", "city", "registration_date"),
            ("orders", "order_id", "status", "created_at"),
            ("payments", "payment_id", "status", "payment_date"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "s12_record_commit",
    one_day(
        f"""SELECT DATE '{LOAD_DATE}' AS load_date, "table" AS entity, rows, true AS stamped FROM ({TABLE_COUNTS})"""
    ),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s12")
    _gated_day(t, root)
    ledger.load_day(t.spark, root, f"{root}/warehouse", LOAD_DATE)
    marker = ledger.read_ledger(t.spark, f"{root}/warehouse")
    return marker.select("load_date", "entity", "rows", F.col("loaded_at").isNotNull().alias("stamped"))


@query(
    "s13_committed_only",
    business(
        """SELECT * FROM p_all WHERE load_date IN (SELECT load_date FROM commits)"""
    ),
)
def _(t: DriverTables) -> DataFrame:
    return ledger.committed_only(t.payments, t.load_commits)


@query(
    "s14_dq_metrics",
    one_day(
        """SELECT entity, sum(valid_rows)::BIGINT AS valid_rows, sum(invalid_rows)::BIGINT AS invalid_rows,
        sum(total_rows)::BIGINT AS total_rows FROM dqm GROUP BY entity"""
    ),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s14")
    _gated_day(t, root)
    return layers.read_day(t.spark, root, "dq_metrics", LOAD_DATE).drop("load_date")


@query(
    "s15_lookback_scan",
    business(
        f"SELECT * FROM ({YEARLY}) WHERE load_date BETWEEN DATE '1999-06-01' - 1000 AND DATE '1999-06-01'"
    ),
)
def _(t: DriverTables) -> DataFrame:
    root = layers.shared_folder(t.spark, "s15")
    _write_by_year(t, root)
    return within_lookback(layers.read_layer(t.spark, root, "payments"), "1999-06-01", 1000)


@query(
    "s16_views",
    business(
        """SELECT city, count(*) AS orders, sum(CASE WHEN is_mature THEN 1 ELSE 0 END)::BIGINT AS mature
        FROM od GROUP BY city"""
    ),
)
def _(t: DriverTables) -> DataFrame:
    t.marts.create_views("s16_")
    return t.spark.sql(
        """SELECT city, count(*) AS orders, sum(CASE WHEN is_mature THEN 1 ELSE 0 END) AS mature
        FROM s16_orders_with_customer_dim GROUP BY city"""
    )


query(
    "s17_ledger_listing", business("SELECT load_date, entity, rows, loaded_at FROM commits")
)(lambda t: ledger.ledger_listing(t.load_commits))
