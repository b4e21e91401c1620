import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from smelter.plans.gold import gold_layer  # noqa: E402
from smelter.plans.silver import silver_layer  # noqa: E402
from smelter.schemas import EXTRACTS  # noqa: E402
from smelter.sources.tables import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("smelter-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.codegen.wholeStage", "false")  # tiny tables: compiling costs more than it saves
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture
def warehouse(spark, folder):
    w = Warehouse(spark, f"{folder}/tables", prefix=Path(folder).name.replace("-", "_") + "_")
    w.create_namespaces()
    return w


@pytest.fixture
def frame(spark):
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


@pytest.fixture
def evaluate(spark):
    """Values of a column rule over a list of inputs."""

    def run(rule, values, ddl_type):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {ddl_type}")
        return [r.y for r in df.select("i", rule(F.col("x")).alias("y")).orderBy("i").collect()]

    return run


@pytest.fixture(scope="session")
def clean_layers(spark):
    """Bronze, silver and gold of six small, clean tables."""
    day = dt.date(2013, 1, 1)
    start, end = dt.datetime(2012, 7, 1), dt.datetime(2013, 7, 1)
    rows = {
        "crm_cust_info": [
            (1, "AW00000001", "Ann", "Lee", "M", "F", day),
            (2, "AW00000002", "Bo", "Ray", "S", "M", day),
            (3, "AW00000003", "Cy", "Fox", "M", None, day),
        ],
        "crm_prd_info": [
            (10, "AC-HE-HL-1", "Helmet", 12, "S", start, None),
            (11, "BI-MB-BK-7", "Bike", 900, "M", start, end),
        ],
        "crm_sales_details": [
            ("SO1", "HL-1", 1, 20130105, 20130107, 20130112, 24, 2, 12),
            ("SO2", "BK-7", 2, 20130106, 20130108, 20130113, 900, 1, 900),
            ("SO3", "HL-1", 3, 0, 20130109, 20130114, 12, 1, 12),
        ],
        "erp_cust_az12": [("NASAW00000001", dt.date(1980, 2, 3), "Female"), ("NASAW00000003", None, "Male")],
        "erp_loc_a101": [("AW-00000001", "France"), ("AW-00000002", "Japan")],
        "erp_px_cat_g1v2": [("AC_HE", "Accessories", "Helmets", "Yes"), ("BI_MB", "Bikes", "Mountain Bikes", "No")],
    }
    bronze = {t: spark.createDataFrame(rows[t], e.schema).cache() for t, e in EXTRACTS.items()}
    silver = {t: df.cache() for t, df in silver_layer(bronze, day).items()}
    gold = {t: df.cache() for t, df in gold_layer(silver).items()}
    return bronze, silver, gold


@pytest.fixture
def tables(clean_layers):
    return dict(clean_layers[0])


@pytest.fixture
def silver(clean_layers):
    return dict(clean_layers[1])


@pytest.fixture
def gold(clean_layers):
    return dict(clean_layers[2])
