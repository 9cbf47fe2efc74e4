import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallyweave-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def code_generation(spark, request):
    """Small fixtures run interpreted, which saves compiling; whole tables run compiled."""
    compiled = "test_catalogue" in request.node.nodeid or "test_cleaning" in request.node.nodeid
    spark.conf.set("spark.sql.codegen.wholeStage", str(compiled).lower())
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK" if compiled else "NO_CODEGEN")
    yield
