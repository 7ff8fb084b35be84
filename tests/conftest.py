import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from pyspark.sql import SparkSession
    from shelflife.session import checkpoint_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="shelflife-warehouse-"))
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def small(spark):
    from shelflife.sources.fixture import staged_tables
    return staged_tables(spark, SF001)


@pytest.fixture(scope="session")
def medium(spark):
    from shelflife.sources.fixture import staged_tables
    return staged_tables(spark, SF01)


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
