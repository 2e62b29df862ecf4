import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from edutide.sources.shipping import ship

    work = tempfile.mkdtemp(prefix="spark-test-")
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"{work}/shared").config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    return session


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
