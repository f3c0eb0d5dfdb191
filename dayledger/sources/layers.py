"""Day partitions of the raw, clean, quarantine and metrics layers."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.sources.schemas import ENTITY_COLUMNS, source_schema


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the one the cluster names in spark.checkpoint.dir.

    Only a local session without that setting falls back to the machine's own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        import tempfile

        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/dayledger-{purpose}-{uuid.uuid4().hex}"


def day_path(root: str, entity: str, load_date: str) -> str:
    return f"{root}/{entity}/load_date={load_date}"


def _condition(error: AnalysisException) -> str:
    return error.getCondition() or ""


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if _condition(error) in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_source_csv(spark: SparkSession, path: str, entity: str, multi_line: bool = True) -> DataFrame:
    """One day of the source export; values are not repaired, a file without rows is refused.

    Quotes inside quoted values are doubled, and quoted values may hold commas and line
    breaks. A file with line breaks in values can only be read by one task; multi_line=False
    lets many tasks read a very large export that has none.
    """
    try:
        rows = (
            spark.read.schema(source_schema(entity))
            .option("header", True)
            .option("encoding", "UTF-8")
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("multiLine", multi_line)
            .csv(path)
        )
    except AnalysisException as error:
        if _condition(error) == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such source file: {path}") from error
        raise
    if rows.isEmpty():
        raise ValueError(f"source file has no rows: {path}")
    return rows


def write_raw(df: DataFrame, root: str, entity: str, load_date: str) -> None:
    """Write a raw day once; a second attempt is refused and a failed one leaves no data."""
    path = day_path(root, entity, load_date)
    try:
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    except AnalysisException as error:
        if _condition(error) == "PATH_ALREADY_EXISTS":
            raise FileExistsError(f"raw day already exists: {path}") from error
        raise


def read_day(spark: SparkSession, root: str, entity: str, load_date: str) -> DataFrame:
    """One day of a layer with its load_date attached again."""
    path = day_path(root, entity, load_date)
    df = read_if_present(spark, path)
    if df is None:
        raise FileNotFoundError(f"no such day: {path}")
    return df.withColumn("load_date", F.to_date(F.lit(load_date)))


def read_layer(spark: SparkSession, root: str, entity: str) -> DataFrame | None:
    """All days of an entity; load_date filters prune partitions."""
    return read_if_present(spark, f"{root}/{entity}")


def write_day(df: DataFrame, root: str, entity: str, load_date: str) -> None:
    """Replace this day only.

    The partition is named in the path, because a dynamic partition overwrite keeps the
    old rows when the new result is empty.
    """
    df.drop("load_date").write.mode("overwrite").parquet(day_path(root, entity, load_date))


def clear_day(spark: SparkSession, root: str, entity: str, load_date: str) -> None:
    """Leave the day with a schema and no rows, if it was ever written."""
    old = read_if_present(spark, day_path(root, entity, load_date))
    if old is not None:
        spark.createDataFrame([], old.schema).write.mode("overwrite").parquet(
            day_path(root, entity, load_date)
        )


def save_ingest_manifest(spark: SparkSession, root: str, load_date: str, counted: DataFrame) -> None:
    """Source file and row count per entity as JSON; a re-run replaces it."""
    counted.select(
        F.lit(load_date).alias("load_date"),
        F.lit("csv").alias("source_format"),
        F.lit("parquet").alias("target_format"),
        "entity",
        "source_file",
        "rows",
    ).coalesce(1).write.mode("overwrite").json(f"{root}/_manifests/load_date={load_date}")


def ingest_day(spark: SparkSession, data_root: str, load_date: str) -> DataFrame:
    """CSV export of a day to raw Parquet for every entity, then the manifest."""
    sources = {
        entity: f"{day_path(f'{data_root}/source', entity, load_date)}/{entity}.csv"
        for entity in ENTITY_COLUMNS
    }
    for entity, path in sources.items():
        write_raw(read_source_csv(spark, path, entity), f"{data_root}/raw", entity, load_date)
    counted = None
    for entity, path in sources.items():
        # The count comes from the Parquet footers of what was really written.
        one = (
            read_day(spark, f"{data_root}/raw", entity, load_date)
            .agg(F.count("*").alias("rows"))
            .select(F.lit(entity).alias("entity"), F.lit(path).alias("source_file"), "rows")
        )
        counted = one if counted is None else counted.unionByName(one)
    save_ingest_manifest(spark, f"{data_root}/raw", load_date, counted)
    return counted


def read_source_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Defects the source announced: load_date, issue_type, expected_rows."""
    raw = spark.read.option("multiLine", True).schema(
        "load_date date, expected_quality_issues map<string, bigint>"
    )
    return raw.json(path).select(
        "load_date", F.explode("expected_quality_issues").alias("issue_type", "expected_rows")
    )


