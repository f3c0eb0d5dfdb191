"""What several operators need: shipping the package, stored tables, word rules."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.sources.layers import shared_folder
from dayledger.sources.storage import remove

#: White space of the word rules: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Stands for a missing id: smaller than every other one.
NO_ID = -(2**63)
#: Of bytes: A-Z become a-z, every other byte stays, so UTF-8 stays intact.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    Python workers then import it like any module, and what a module keeps between tasks
    (a loaded tokenizer) stays in the worker.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(os.path.realpath(tempfile.mkdtemp()), "dayledger_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write under the shared folder and read back: cuts the lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table that `stored` wrote, after its last use."""
    files = table.inputFiles()
    if files:
        remove(table.sparkSession, files[0].rsplit("/", 1)[0])


@contextmanager
def shuffles_end_with_their_query(spark: SparkSession) -> Iterator[None]:
    """Let Spark remove a query's shuffle files when it ends, not when the driver forgets it.

    For steps that store what they made: nothing reads these files a second time.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z and nothing else changes.

    lower() does the same wherever the characters beyond ASCII have no capitals among
    them, and is much faster than translate().
    """
    beyond = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(beyond == F.lower(beyond), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than SPACES; none for a null or empty text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")
