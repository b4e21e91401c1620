"""The warehouse's namespaces and tables in the session catalog."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.schemas import AUDIT_COLUMN, BRONZE, EXTRACTS, LAYERS, SILVER, silver_schema
from smelter.session import shuffles_go

CATALOG = threading.Lock()  # one change of the catalog at a time, whatever runs side by side


class Warehouse:
    """Parquet tables in the namespaces bronze, silver and gold.

    A declared table lies in a folder of its own per version. A refresh writes the next version beside it and then moves the
    table's location, so that readers see all old rows or all new ones; the version before stays for readers that began with it.

    ``location`` is a folder shared by all executors; without it Spark's warehouse folder is used. ``prefix`` goes
    before each namespace name, so that several warehouses can share a catalog.
    """

    def __init__(self, spark: SparkSession, location: str | None = None, prefix: str = ""):
        self.spark = spark
        self.location = location.rstrip("/") if location else None
        self.prefix = prefix

    # ---- names ----

    def namespace(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.namespace(layer)}.{table}"

    # ---- namespaces ----

    def create_namespaces(self, reset: bool = False) -> None:
        """Create the three namespaces; ``reset`` first drops them with all their tables."""
        if reset:
            self.drop()
        for layer in LAYERS:
            place = f" LOCATION '{self.location}/{layer}'" if self.location else ""
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.namespace(layer)}{place}")

    def drop(self) -> None:
        """Drop the three namespaces with all their tables, and their folders."""
        for layer in LAYERS:
            self.spark.sql(f"DROP SCHEMA IF EXISTS {self.namespace(layer)} CASCADE")
            # Folders of versions aren't the catalog's, nor does one of this session alone know what an earlier session stored.
            self._delete(self.folder(layer))

    # ---- versions ----

    def folder(self, layer: str) -> str:
        """Where the layer's tables lie."""
        if self.location:
            return f"{self.location}/{layer}"
        return f"{self.spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{self.namespace(layer)}.db"

    def new_version(self, layer: str, table: str) -> str:
        """A folder for the table's next rows, which no reader sees before ``publish``."""
        return f"{self._versions(layer, table)}/{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def publish(self, layer: str, table: str, schema: T.StructType, version: str, rows: str = "") -> None:
        """Let the table of that schema hold the version's rows, of its folder ``rows`` if named; older versions but one go."""
        with CATALOG:
            self._publish(layer, table, schema, version, rows)

    def _publish(self, layer: str, table: str, schema: T.StructType, version: str, rows: str) -> None:
        name, place = self.name(layer, table), f"{version}/{rows}".rstrip("/")
        self._path(place)[1].mkdirs(self._path(place)[0])  # a version without rows has no folder yet
        if self.exists(layer, table) and self._declares(layer, table, schema):
            before = self._location(layer, table)
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        else:
            before = ""
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{place}'")
        versions, files = self._path(self._versions(layer, table))
        for found in files.listStatus(versions):
            kept = found.getPath().getName()
            if kept not in place and kept not in before:
                files.delete(found.getPath(), True)

    def refresh(self, layer: str, table: str, schema: T.StructType, df: DataFrame) -> None:
        """Full refresh of a declared table. If the write fails, the table keeps its rows."""
        version = self.new_version(layer, table)
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        try:
            with shuffles_go(self.spark):
                df.select(*columns).write.parquet(version)
        except Exception:
            self._delete(version)
            raise
        self.publish(layer, table, schema, version)

    def _versions(self, layer: str, table: str) -> str:
        return f"{self.folder(layer)}/versions-{table}"

    def _path(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _delete(self, folder: str) -> None:
        path, files = self._path(folder)
        files.delete(path, True)

    def _location(self, layer: str, table: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}")
        return described.filter("col_name = 'Location'").first()["data_type"]

    def _declares(self, layer: str, table: str, schema: T.StructType) -> bool:
        held = self.read(layer, table).schema
        return [(f.name, f.dataType) for f in held.fields] == [(f.name, f.dataType) for f in schema.fields]

    # ---- declared tables ----

    def create_table(self, layer: str, table: str, schema: T.StructType) -> None:
        """An empty table with a declared schema, in place of one of that name."""
        self.publish(layer, table, schema, self.new_version(layer, table))

    def create_declared_tables(self) -> None:
        """The six bronze and six silver tables, empty."""
        for table, extract in EXTRACTS.items():
            self.create_table(BRONZE, table, extract.schema)
            self.create_table(SILVER, table, silver_schema(table))

    # ---- reading ----

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def read_files(self, layer: str, table: str) -> DataFrame:
        """A stored table's rows read from its files without its buckets: tasks take splits of the files, not a bucket each."""
        name = self.name(layer, table)
        location = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
        return self.spark.read.schema(self.read(layer, table).schema).parquet(location)

    def find(self, layer: str, table: str) -> DataFrame | None:
        return self.read(layer, table) if self.exists(layer, table) else None

    def tables(self, layer: str) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.namespace(layer)) if not t.isTemporary)

    def columns(self) -> DataFrame:
        """Every column of every table: ``(layer, table_name, position, column_name, data_type)``."""
        listed = [
            (layer, table, i, c.name, c.dataType)
            for layer in LAYERS
            for table in self.tables(layer)
            for i, c in enumerate(self.spark.catalog.listColumns(self.name(layer, table)), start=1)
        ]
        return self.spark.createDataFrame(
            listed, "layer STRING, table_name STRING, position INT, column_name STRING, data_type STRING"
        )

    # ---- writing ----

    def overwrite(
        self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = (), buckets: int = 0, bucket_by: str = ""
    ) -> None:
        """Full refresh: the table holds the new rows only, in ``buckets`` sorted by ``bucket_by`` if there are any."""
        if buckets:  # rows of a bucket move together before the write; tasks of bounded size write a file per bucket they hold
            df = df.hint("rebalance", F.col(bucket_by))
        # The table's own setting: an insert that overwrites replaces the partitions of its rows, not the table.
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).format("parquet")
        if buckets:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        with shuffles_go(self.spark):
            writer.saveAsTable(self.name(layer, table))

    def replace_partitions(self, layer: str, table: str, df: DataFrame) -> None:
        """Replace the partitions that the rows lie in, of a table stored by ``overwrite``; all others keep their files."""
        columns = self.read(layer, table).columns
        with shuffles_go(self.spark):
            df.select(*columns).write.insertInto(self.name(layer, table), overwrite=True)

    def append(
        self, layer: str, table: str, df: DataFrame, columns: Sequence[str], loaded_at: dt.datetime | None = None
    ) -> None:
        """Add rows, matching the named columns by name. Unnamed ones become NULL, the load time becomes now."""
        target = self.read(layer, table).schema
        row = {c: F.col(c) for c in columns}
        if AUDIT_COLUMN in target.names and AUDIT_COLUMN not in row:
            row[AUDIT_COLUMN] = load_time(loaded_at)
        unknown = set(row) - set(target.names)
        if unknown:
            raise ValueError(f"{self.name(layer, table)} has no column {sorted(unknown)}")
        added = df.select(*[row.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields])
        with shuffles_go(self.spark):
            added.write.insertInto(self.name(layer, table))

    def create_view(self, layer: str, view: str, table: str, columns: Sequence[str]) -> None:
        """A persistent view of a stored table's columns, in place of one of that name."""
        listed = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, view)} AS SELECT {listed} FROM {self.name(layer, table)}")

    def add_column(self, layer: str, table: str, column: str, data_type: str, default: str) -> bool:
        """Add a column unless it is there. Rows already stored read as ``default``; no file is rewritten."""
        if column in self.read(layer, table).columns:
            return False
        self.spark.sql(f"ALTER TABLE {self.name(layer, table)} ADD COLUMNS ({column} {data_type} DEFAULT {default})")
        return True


def load_time(loaded_at: dt.datetime | None = None):
    return F.current_timestamp() if loaded_at is None else F.lit(loaded_at)


def with_load_time(df: DataFrame, loaded_at: dt.datetime | None = None) -> DataFrame:
    return df.withColumn(AUDIT_COLUMN, load_time(loaded_at))

