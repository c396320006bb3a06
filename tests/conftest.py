import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from revops_spark.session import configure

    scratch = tempfile.mkdtemp(prefix="revops-test-")
    session = (SparkSession.builder.master("local[*]")
               .appName("revops_spark-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
               .config("spark.checkpoint.dir", os.path.join(scratch, "shared"))
               .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="revops-case-")


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
