import datetime as dt
import os
import re
import time

import pytest

from smelter.schemas import AUDIT_COLUMN, BRONZE, EXTRACTS, GOLD, SILVER, silver_schema
from smelter.session import SHUFFLES_GO, new_folder, shared_folder, shuffles_go, written_once
from smelter.sources.extracts import write_extract
from smelter.sources.tables import with_load_time

WHEN = dt.datetime(2024, 5, 6, 7, 8, 9)


def test_namespaces_and_declared_tables(warehouse):
    warehouse.create_declared_tables()
    assert warehouse.tables(BRONZE) == sorted(EXTRACTS)
    assert warehouse.tables(SILVER) == sorted(EXTRACTS)
    assert warehouse.tables(GOLD) == []
    assert warehouse.exists(BRONZE, "erp_loc_a101") and not warehouse.exists(GOLD, "erp_loc_a101")
    assert warehouse.find(GOLD, "fact_sales") is None
    listed = [tuple(r) for r in warehouse.columns().filter("table_name = 'erp_cust_az12'").orderBy("layer", "position").collect()]
    assert listed == [
        ("bronze", "erp_cust_az12", 1, "cid", "string"), ("bronze", "erp_cust_az12", 2, "bdate", "date"),
        ("bronze", "erp_cust_az12", 3, "gen", "string"), ("silver", "erp_cust_az12", 1, "cid", "string"),
        ("silver", "erp_cust_az12", 2, "bdate", "date"), ("silver", "erp_cust_az12", 3, "gen", "string"),
        ("silver", "erp_cust_az12", 4, AUDIT_COLUMN, "timestamp"),
    ]


def test_reset_drops_what_was_there(warehouse):
    warehouse.create_declared_tables()
    warehouse.create_namespaces()
    assert warehouse.exists(BRONZE, "crm_prd_info")
    warehouse.create_namespaces(reset=True)
    assert warehouse.tables(BRONZE) == []


def test_create_table_replaces(warehouse, frame):
    warehouse.overwrite(SILVER, "t", frame([(1,)], "a INT"))
    warehouse.create_table(SILVER, "t", frame([], "b STRING, c DATE").schema)
    assert warehouse.read(SILVER, "t").columns == ["b", "c"] and warehouse.read(SILVER, "t").count() == 0


def test_append_matches_columns_by_name_and_adds_the_load_time(warehouse, frame):
    warehouse.create_table(SILVER, "erp_loc_a101", silver_schema("erp_loc_a101"))
    warehouse.append(SILVER, "erp_loc_a101", frame([("France", "A")], "cntry STRING, cid STRING"), ["cntry", "cid"], WHEN)
    warehouse.append(SILVER, "erp_loc_a101", frame([("B", "Peru")], "cid STRING, cntry STRING"), ["cid"])
    got = {r.cid: r for r in warehouse.read(SILVER, "erp_loc_a101").collect()}
    assert (got["A"].cntry, got["A"][AUDIT_COLUMN]) == ("France", WHEN)
    assert got["B"].cntry is None and got["B"][AUDIT_COLUMN] is not None


def test_append_refuses_unknown_columns(warehouse, frame):
    warehouse.overwrite(SILVER, "t", frame([], "a INT"))
    with pytest.raises(ValueError, match="zzz"):
        warehouse.append(SILVER, "t", frame([(1, 2)], "a INT, zzz INT"), ["a", "zzz"])


def test_overwrite_can_change_the_schema_and_partition(warehouse, frame):
    warehouse.overwrite(GOLD, "t", frame([(1,)], "a INT"))
    warehouse.overwrite(GOLD, "t", frame([(1, 2013), (2, None)], "a INT, y INT"), ["y"])
    assert sorted((tuple(r) for r in warehouse.read(GOLD, "t").collect()), key=str) == [(1, 2013), (2, None)]


def test_added_column_reads_as_its_default(warehouse, frame):
    warehouse.overwrite(SILVER, "t", frame([(1,)], "a INT"))
    assert warehouse.add_column(SILVER, "t", "flag", "INT", "0")
    assert not warehouse.add_column(SILVER, "t", "flag", "INT", "0")
    warehouse.append(SILVER, "t", frame([(2, 1)], "a INT, flag INT"), ["a", "flag"])
    assert sorted(tuple(r) for r in warehouse.read(SILVER, "t").collect()) == [(1, 0), (2, 1)]


def test_load_time(frame):
    assert with_load_time(frame([(1,)], "a INT"), WHEN).first()[AUDIT_COLUMN] == WHEN


def test_a_dropped_warehouse_leaves_nothing(warehouse, frame, folder):
    warehouse.overwrite(SILVER, "t", frame([(1,)], "a INT"))
    warehouse.drop()
    assert not os.path.exists(f"{warehouse.location}/silver")
    warehouse.create_namespaces()
    assert warehouse.tables(SILVER) == []


class Session:
    """Stands in for a session's settings."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key.replace(".", "_"), default)

    def set(self, key, value):
        self.settings[key.replace(".", "_")] = value


def test_the_warehouse_holds_scratch_tables_where_no_folder_is_set():
    for master in ("spark://somewhere:7077", "local[2]"):
        assert shared_folder(Session(spark_master=master, spark_sql_warehouse_dir="/w/")) == "/w/_scratch"


def test_the_cluster_s_folder_is_used_with_a_new_name_each_time():
    cluster = Session(spark_master="spark://somewhere:7077", spark_checkpoint_dir="/shared/checkpoints/")
    assert shared_folder(cluster) == "/shared/checkpoints"
    first, second = new_folder(cluster, "x"), new_folder(cluster, "x")
    assert first.startswith("/shared/checkpoints/x-") and first != second


def test_a_refresh_is_seen_whole_or_not_at_all(warehouse, frame):
    schema = frame([], "a INT, b STRING").schema
    warehouse.refresh(SILVER, "t", schema, frame([("x", 1)], "b STRING, a INT"))
    before = warehouse.read(SILVER, "t")
    warehouse.refresh(SILVER, "t", schema, frame([("y", 2), ("z", 3)], "b STRING, a BIGINT"))
    assert [tuple(r) for r in before.collect()] == [(1, "x")]  # a reader that began with the old version
    assert sorted(tuple(r) for r in warehouse.read(SILVER, "t").collect()) == [(2, "y"), (3, "z")]
    assert warehouse.read(SILVER, "t").schema.simpleString() == "struct<a:int,b:string>"


def test_a_failed_refresh_leaves_the_rows(warehouse, frame):
    from pyspark.sql import functions as F

    schema = frame([], "a INT").schema
    warehouse.refresh(SILVER, "t", schema, frame([(1,)], "a INT"))
    with pytest.raises(Exception, match="stopped"):
        warehouse.refresh(SILVER, "t", schema, frame([(1,), (2,)], "a INT").withColumn("a", F.when(F.col("a") < 2, 1).otherwise(F.raise_error(F.lit("stopped")).cast("int"))))
    assert [tuple(r) for r in warehouse.read(SILVER, "t").collect()] == [(1,)]


def test_versions_but_the_last_two_are_removed(warehouse, frame):
    schema = frame([], "a INT").schema
    for i in range(4):
        warehouse.refresh(SILVER, "t", schema, frame([(i,)], "a INT"))
    assert len(os.listdir(f"{warehouse.location}/silver/versions-t")) == 2
    warehouse.append(SILVER, "t", frame([(9,)], "a INT"), ["a"])
    assert sorted(tuple(r) for r in warehouse.read(SILVER, "t").collect()) == [(3,), (9,)]


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", blocks.getAllFiles().toString()))


def test_shuffles_of_writes_go_with_them(spark, warehouse, folder, tables):
    before = shuffle_files(spark)
    places = tables["erp_loc_a101"].repartition(2, "cid")
    warehouse.refresh(SILVER, "erp_loc_a101", silver_schema("erp_loc_a101"), with_load_time(places, WHEN))
    warehouse.overwrite(GOLD, "t", places)
    warehouse.overwrite(GOLD, "parted", places, ["cntry"])
    warehouse.append(GOLD, "t", places, places.columns)
    written_once(places, "places")
    write_extract(places, "erp_loc_a101", folder)
    for _ in range(100):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left


def test_writes_side_by_side_leave_the_setting_as_it_was(spark):
    before = spark.conf.get(SHUFFLES_GO)
    first, second = shuffles_go(spark), shuffles_go(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLES_GO) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLES_GO) == before
