"""Tables of the latest version of every key, published state by state.

A state is what a load leaves behind: for each entity and each month in which its rows were
created a base, and small deltas of keys that later loads changed. Readers merge them: of a
key that a month's deltas name, the newest delta counts, and its base row does not. A load
writes deltas for the months that its keys fall into, and a new base only for months whose
deltas have grown large. Everything it writes goes to folders named after its commit, and a
manifest, written last, lists the folders of the state and the commits it holds. Nothing is
ever overwritten, so a crash leaves at most folders nobody names, and a reader keeps the
state it opened until `vacuum` removes it.

A state counts while the commits it holds are exactly those in the ledger. The marker of a
load, written after its state, is therefore what publishes it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.operators.lookups import join_by_key
from dayledger.operators.versions import latest_version
from dayledger.plans.marts import KEYS, TIE_BREAKS
from dayledger.sources.layers import read_day, read_if_present, read_layer
from dayledger.sources.storage import names_in, remove

ROOT = "_current"
STATES = f"{ROOT}/_states"
#: When the thing a key stands for came about; its month is where the row is kept.
CREATED = {"customers": "registration_date", "orders": "created_at", "payments": "payment_date"}
UNDATED = "none"
#: A month gets a new base once its deltas hold more than this share of the base's rows, or
#: once there are so many of them.
DELTA_SHARE = 0.25
MOST_DELTAS = 8
#: A load of more rows than this, and than that share of all bases, is not written as deltas
#: first: they would all be merged at once.
SMALL_LOAD = 10_000
MANIFEST = "item string, load_date date, commit string, entity string, month string, folder string, step long, rows long"
Commits = Mapping[date, str]


@dataclass
class State:
    """What a manifest says: commits by day, and per entity and month the base and the deltas."""

    name: str
    step: int = 0
    commits: dict[date, str] = field(default_factory=dict)
    #: (entity, month) -> (folder, rows), and the same for deltas, oldest first.
    bases: dict[tuple[str, str], tuple[str, int]] = field(default_factory=dict)
    deltas: dict[tuple[str, str], list[tuple[str, int]]] = field(default_factory=dict)


def _states(spark: SparkSession, warehouse: str) -> list[State]:
    """All states there are, the newest first; a manifest has a row for each day and folder."""
    if not names_in(spark, f"{warehouse}/{STATES}"):
        return []
    rows = read_if_present(spark, f"{warehouse}/{STATES}")
    found: dict[str, State] = {}
    for r in [] if rows is None else rows.orderBy("step").collect():
        state = found.setdefault(r.state, State(r.state))
        if r.item == "commit":
            state.commits[r.load_date] = r.commit
            state.step = r.step
        elif r.item == "base":
            state.bases[r.entity, r.month] = (r.folder, r.rows)
        else:
            state.deltas.setdefault((r.entity, r.month), []).append((r.folder, r.rows))
    return sorted(found.values(), key=lambda s: -s.step)


def _write_manifest(spark: SparkSession, warehouse: str, state: State) -> None:
    rows = [("commit", day, commit, None, None, None, state.step, None) for day, commit in state.commits.items()]
    for (entity, month), (folder, n) in state.bases.items():
        rows.append(("base", None, None, entity, month, folder, 0, n))
    for (entity, month), parts in state.deltas.items():
        rows += [("delta", None, None, entity, month, folder, k, n) for k, (folder, n) in enumerate(parts)]
    manifest = spark.createDataFrame(rows, MANIFEST)
    manifest.coalesce(1).write.parquet(f"{warehouse}/{STATES}/state={state.name}")


def _path(warehouse: str, entity: str, folder: str, kind: str, month: str) -> str:
    return f"{warehouse}/{ROOT}/{entity}/{folder}/{kind}/month={month}"


def _months(rows: DataFrame, entity: str) -> DataFrame:
    month = F.date_format(CREATED[entity], "yyyy-MM")
    return rows.withColumn("_month", F.coalesce(month, F.lit(UNDATED)))


def _write(rows: DataFrame, warehouse: str, entity: str, folder: str, kind: str) -> dict[str, int]:
    """Rows by month to a new folder; returns how many each month got."""
    path = f"{warehouse}/{ROOT}/{entity}/{folder}/{kind}"
    rows.withColumn("month", F.col("_month")).write.partitionBy("month").parquet(path)
    written = read_if_present(rows.sparkSession, path)
    return {} if written is None else {r["_month"]: r["count"] for r in written.groupBy("_month").count().collect()}


def _schema(spark: SparkSession, warehouse: str, entity: str) -> T.StructType:
    return read_layer(spark, warehouse, entity).schema


def _same(left: DataFrame, right: DataFrame, columns: Iterable[str]) -> Column:
    return reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in columns))


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _merged(spark: SparkSession, warehouse: str, entity: str, state: State, months: set[str] | None = None) -> DataFrame:
    """The rows of an entity in a state, with their month, of all months or of some.

    Only bases of months with deltas meet the deltas' keys; where these are small they are
    broadcast by their size, so the bases are not shuffled.
    """
    schema = _schema(spark, warehouse, entity).add("_month", "string")
    keys = [*KEYS[entity], "_month"]

    def wanted(held: Mapping[tuple[str, str], object]) -> list[str]:
        return sorted(m for e, m in held if e == entity and (months is None or m in months))

    changed = wanted(state.deltas)

    def bases(of: Iterable[str]) -> list[str]:
        return [_path(warehouse, entity, state.bases[entity, m][0], "base", m) for m in of if (entity, m) in state.bases]

    rest = _read(spark, bases(set(wanted(state.bases)) - set(changed)), schema)
    if not changed:
        return rest
    paths = [_path(warehouse, entity, folder, "delta", m) for m in changed for folder, _ in state.deltas[entity, m]]
    deltas = _read(spark, paths, T.StructType([*schema, *_MARKS]))
    newest = latest_version(deltas, keys, version="_step")
    named = newest.select(keys)
    base = _read(spark, bases(changed), schema)
    kept = base.join(named, _same(base, named, keys), "left_anti")
    stays = newest.where("NOT _gone").select(schema.names)
    return rest.unionByName(kept).unionByName(stays)


_MARKS = T.StructType().add("_step", "long").add("_gone", "boolean")


def _latest(df: DataFrame, entity: str) -> DataFrame:
    return latest_version(df, KEYS[entity], tie_breaks=[c for c in TIE_BREAKS[entity] if c in df.columns])


def _history(spark: SparkSession, warehouse: str, entity: str, days: Iterable[date]) -> DataFrame:
    """Rows of committed days."""
    known = spark.createDataFrame([(d,) for d in days], "load_date date")
    return join_by_key(read_layer(spark, warehouse, entity), known, "load_date", "left_semi")


def _delta(
    spark: SparkSession, warehouse: str, entity: str, load_date: str, before: State, others: Commits, step: int
) -> DataFrame:
    """What the load changes: each key's row as it is now, and `_gone` where a month lost it."""
    keys, day = list(KEYS[entity]), date.fromisoformat(load_date)
    new = read_day(spark, warehouse, entity, load_date)
    again = day in before.commits
    if not again and CREATED[entity] in keys:  # the key says in which months its rows are
        months = {r["_month"] for r in _months(new, entity).select("_month").distinct().collect()}
        held = _merged(spark, warehouse, entity, before, months)
    else:
        held = _merged(spark, warehouse, entity, before)
    changed = new.select(keys)
    if again:
        changed = changed.unionByName(held.where(F.col("load_date") == day).select(keys))
    changed = changed.distinct()
    held = held.join(changed, _same(held, changed, keys), "left_semi")
    versions = held.drop("_month")
    if again:  # what the day held may be gone, or an older version may count again
        history = _history(spark, warehouse, entity, others)
        versions = history.join(changed, _same(history, changed, keys), "left_semi")
    columns = _schema(spark, warehouse, entity).names
    now = _months(_latest(versions.select(columns).unionByName(new.select(columns)), entity), entity)
    places = [*keys, "_month"]
    there = now.select(places)
    lost = held.join(there, _same(held, there, places), "left_anti")
    marked = now.withColumn("_gone", F.lit(False)).unionByName(lost.withColumn("_gone", F.lit(True)))
    return marked.withColumn("_step", F.lit(step).cast("long"))


def _due(base: int, deltas: list[tuple[str, int]]) -> bool:
    return len(deltas) > MOST_DELTAS or sum(n for _, n in deltas) > DELTA_SHARE * base


def _mostly_new(spark: SparkSession, warehouse: str, entity: str, load_date: str, before: State) -> bool:
    """Whether the day has so many rows that nearly every month would get a delta and a new base.

    Counted from the footers of the day's files. What the day held before is not counted.
    """
    held = sum(n for (e, _), (_, n) in before.bases.items() if e == entity)
    return read_day(spark, warehouse, entity, load_date).count() > max(DELTA_SHARE * held, SMALL_LOAD)


def publish(spark: SparkSession, warehouse: str, load_date: str, commit: str, committed: Commits) -> None:
    """Write the state with a day whose rows are in the warehouse but not yet committed.

    committed: the commits in the ledger without this load. The day may be older than days
    already held, and may have been held before. Without a state that holds the other days
    as they are, all months are built from the history; so are those of an entity of which
    the day holds a great part.
    """
    day = date.fromisoformat(load_date)
    others = {d: c for d, c in committed.items() if d != day}
    states = _states(spark, warehouse)
    before = next((s for s in states if {d: c for d, c in s.commits.items() if d != day} == others), None)
    state = State(commit, 1 + max((s.step for s in states), default=0), {**others, day: commit})
    for entity in KEYS:
        if before is None or _mostly_new(spark, warehouse, entity, load_date, before):
            rows = _history(spark, warehouse, entity, [*others, day])
            counts = _write(_months(_latest(rows, entity), entity), warehouse, entity, commit, "base")
            state.bases |= {(entity, month): (commit, n) for month, n in counts.items()}
            continue
        delta = _delta(spark, warehouse, entity, load_date, before, others, state.step)
        counts = _write(delta, warehouse, entity, commit, "delta")
        state.bases |= {place: base for place, base in before.bases.items() if place[0] == entity}
        state.deltas |= {place: list(parts) for place, parts in before.deltas.items() if place[0] == entity}
        for month, n in counts.items():
            state.deltas.setdefault((entity, month), []).append((commit, n))
        due = {m for m in counts if _due(state.bases.get((entity, m), ("", 0))[1], state.deltas[entity, m])}
        if due:
            rebuilt = _write(_merged(spark, warehouse, entity, state, due), warehouse, entity, commit, "base")
            for month in due:
                del state.deltas[entity, month]
                state.bases.pop((entity, month), None)
            state.bases |= {(entity, month): (commit, n) for month, n in rebuilt.items()}
    _write_manifest(spark, warehouse, state)


def current_tables(spark: SparkSession, warehouse: str, committed: Commits) -> dict[str, DataFrame] | None:
    """The three tables, one row per key; None where no state holds exactly these commits."""
    state = next((s for s in _states(spark, warehouse) if s.commits == dict(committed)), None)
    if state is None:
        return None
    return {entity: _merged(spark, warehouse, entity, state).drop("_month") for entity in KEYS}


def vacuum(spark: SparkSession, warehouse: str, committed: Commits, keep: int = 2) -> list[str]:
    """Remove what no state needs but the one that counts and the `keep` newest; returns the folders.

    Not to be run during a load, whose folders no manifest names yet, nor while somebody
    still reads an older state.
    """
    states = _states(spark, warehouse)
    kept = [s for n, s in enumerate(states) if n < keep or s.commits == dict(committed)]
    gone = {f"{STATES}/state={s.name}" for s in states} - {f"{STATES}/state={s.name}" for s in kept}
    for entity in KEYS:
        needed = {folder for s in kept for (e, _), (folder, _) in s.bases.items() if e == entity}
        needed |= {folder for s in kept for (e, _), parts in s.deltas.items() if e == entity for folder, _ in parts}
        gone |= {f"{ROOT}/{entity}/{name}" for name in names_in(spark, f"{warehouse}/{ROOT}/{entity}") if name not in needed}
    for path in sorted(gone):  # a manifest sorts before the folders it names
        remove(spark, f"{warehouse}/{path}")
    return sorted(gone)
