import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="basketry-test-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("basketry-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


LINE_SCHEMA = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, "
    "UnitPrice decimal(18,2), CustomerID string, Country string"
)
