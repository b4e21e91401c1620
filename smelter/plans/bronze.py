"""Bronze load: extracts into raw tables, with an audit row per table."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.schemas import BRONZE, EXTRACTS, columns_of
from smelter.session import run_together
from smelter.sources.extracts import REASON, read_extract, read_schema, rejected
from smelter.sources.tables import Warehouse

AUDIT_TABLE = "load_audit"
REJECTS_TABLE = "load_rejects"
BATCH = "*"
AUDIT_SCHEMA = columns_of(
    batch_id=T.StringType(),
    table_name=T.StringType(),
    started_at=T.TimestampType(),
    ended_at=T.TimestampType(),
    rows_loaded=T.LongType(),
    rows_rejected=T.LongType(),
    status=T.StringType(),
    error=T.StringType(),
    error_condition=T.StringType(),
    error_state=T.StringType(),
)
REJECTS_SCHEMA = columns_of(batch_id=T.StringType(), table_name=T.StringType(), reason=T.StringType(), record=T.StringType())
LOADED, REJECTS, FAILED = "LOADED", "REJECTS", "FAILED"
KEEP, FAIL, EMPTY = "keep", "fail", "empty"
KIND, ACCEPTED, REJECTED = "kind", "accepted", "rejected"


class LoadFailed(RuntimeError):
    """A table could not be loaded; its audit row is written."""


class RowsRejected(RuntimeError):
    """An extract has broken rows, and the policy is to take none of its rows then."""

    def __init__(self, table: str, load: Load):
        super().__init__(f"{table}: {load.rejected} broken rows")
        self.load = load


@dataclass(frozen=True)
class Load:
    """What one pass over an extract found: numbers of rows, and the folder of the broken ones."""

    loaded: int
    rejected: int
    rejects: str


def load_table(warehouse: Warehouse, table: str, base_path: str, on_reject: str = KEEP, on_failure: str = EMPTY) -> Load:
    """Replace a bronze table by its extract.

    One pass reads the extract, counts its rows and writes them to the table's next version, good and broken ones in a
    folder each; then the table moves to the good ones. A load that fails leaves the table with its declared schema, empty or,
    with ``on_failure="keep"``, with its old rows. With ``on_reject="fail"`` a broken row is such a failure.
    """
    schema = EXTRACTS[table].schema
    version = warehouse.new_version(BRONZE, table)
    try:
        counts, broken = Observation(), F.col(REASON).isNotNull()
        rows = read_extract(warehouse.spark, table, base_path).observe(
            counts,
            F.count(F.when(~broken, 1)).alias("loaded"),
            F.count(F.when(broken, 1)).alias("rejected"),
        )
        parted = rows.withColumn(KIND, F.when(broken, REJECTED).otherwise(ACCEPTED))
        parted.write.partitionBy(KIND).parquet(version)
        load = Load(counts.get["loaded"], counts.get["rejected"], f"{version}/{KIND}={REJECTED}")
        if load.rejected and on_reject == FAIL:
            raise RowsRejected(table, load)
    except Exception as error:
        rejected_only = isinstance(error, RowsRejected)
        if on_failure == EMPTY or not warehouse.exists(BRONZE, table):
            warehouse.publish(BRONZE, table, schema, version if rejected_only else warehouse.new_version(BRONZE, table), "none")
        raise
    warehouse.publish(BRONZE, table, schema, version, f"{KIND}={ACCEPTED}")
    return load


def load_bronze(
    warehouse: Warehouse,
    base_path: str = "datasets",
    on_error: str = "raise",
    on_reject: str = KEEP,
    on_failure: str = EMPTY,
) -> DataFrame:
    """Full refresh of the six bronze tables from the extracts below ``base_path``; returns the batch's audit.

    The tables are loaded side by side. Broken rows are stored, however many, and counted in the audit; ``on_reject``
    says whether the table's other rows are kept or the table fails, and ``on_failure`` whether a failed table is empty then
    or keeps its old rows. A failed table gets an audit row too; then the first error is raised, or with
    ``on_error="record"`` only recorded.
    """
    if on_error not in ("raise", "record"):
        raise ValueError(f"on_error must be 'raise' or 'record', not {on_error!r}")
    if on_reject not in (KEEP, FAIL):
        raise ValueError(f"on_reject must be 'keep' or 'fail', not {on_reject!r}")
    if on_failure not in (EMPTY, KEEP):
        raise ValueError(f"on_failure must be 'empty' or 'keep', not {on_failure!r}")
    for name, schema in ((AUDIT_TABLE, AUDIT_SCHEMA), (REJECTS_TABLE, REJECTS_SCHEMA)):
        if not warehouse.exists(BRONZE, name):
            warehouse.create_table(BRONZE, name, schema)

    batch_id, batch_start = uuid.uuid4().hex, _now()
    entries: dict[str, tuple] = {}
    failures: dict[str, Exception] = {}
    broken: dict[str, str] = {}

    def load(table: str) -> None:
        start = _now()
        try:
            done = load_table(warehouse, table, base_path, on_reject, on_failure)
        except Exception as error:  # whatever stopped the load belongs in the audit
            failures[table] = error
            found = error.load if isinstance(error, RowsRejected) else Load(0, 0, "")
            entries[table] = (batch_id, table, start, _now(), 0, found.rejected, FAILED, *_described(error))
        else:
            found = done
            status = REJECTS if done.rejected else LOADED
            entries[table] = (batch_id, table, start, _now(), done.loaded, done.rejected, status, None, None, None)
        if found.rejected:
            broken[table] = found.rejects

    run_together(warehouse.spark, [partial(load, t) for t in EXTRACTS])
    listed = [entries[t] for t in EXTRACTS]
    with_rejects = [t for t in EXTRACTS if t in broken]
    if with_rejects:  # one writer, over the broken rows that the loads have set aside
        frames = [rejected(warehouse.spark.read.schema(read_schema(t)).parquet(broken[t]), t) for t in with_rejects]
        rejects = reduce(DataFrame.unionByName, frames).withColumn("batch_id", F.lit(batch_id))
        warehouse.append(BRONZE, REJECTS_TABLE, rejects, rejects.columns)
    totals = [sum(e[i] for e in listed) for i in (4, 5)]
    status = FAILED if failures else REJECTS if with_rejects else LOADED
    listed.append((batch_id, BATCH, batch_start, _now(), *totals, status, None, None, None))
    audit = warehouse.spark.createDataFrame(listed, AUDIT_SCHEMA)
    warehouse.append(BRONZE, AUDIT_TABLE, audit, audit.columns)
    if failures and on_error == "raise":
        table = next(t for t in EXTRACTS if t in failures)
        raise LoadFailed(f"bronze load failed at {table}: {failures[table]}") from failures[table]
    return load_audit(warehouse, batch_id)


def load_rejects(warehouse: Warehouse, batch_id: str | None = None) -> DataFrame:
    """Broken rows as they were read, of one batch or of all."""
    rejects = warehouse.read(BRONZE, REJECTS_TABLE)
    return rejects if batch_id is None else rejects.filter(F.col("batch_id") == batch_id)


def load_audit(warehouse: Warehouse, batch_id: str | None = None) -> DataFrame:
    """Audit rows with their duration in whole seconds: one per table, and one named ``*`` for the batch."""
    audit = warehouse.read(BRONZE, AUDIT_TABLE)
    if batch_id is not None:
        audit = audit.filter(F.col("batch_id") == batch_id)
    return audit.withColumn("seconds", F.timestamp_diff("SECOND", "started_at", "ended_at"))


def _described(error: Exception) -> tuple[str, str | None, str | None]:
    """Message, condition and SQL state; other errors than Spark's have their type for a condition."""
    if isinstance(error, PySparkException):
        return str(error), error.getCondition(), error.getSqlState()
    return str(error), type(error).__name__, None


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)
