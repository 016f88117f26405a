import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ledgerline.session import SCALE_CONFS, ensure_checkpoint_dir

    scratch = tempfile.mkdtemp(prefix="ledgerline-test-")
    b = (
        SparkSession.builder.master("local[*]")
        .appName("ledgerline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.memory", "8g")
    )
    for k, v in SCALE_CONFS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from ledgerline.sources.tables import DRIVER_TABLES, table_path

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = table_path(SF01, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con
