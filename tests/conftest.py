from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripmart.session import build_session  # noqa: E402


def make_session():
    spark = build_session(
        "tripmart-tests",
        spark__master="local[8]",
        spark__ui__enabled="false",
        # Finding the caller of each column expression is slow below pytest's deep stack
        spark__python__sql__dataFrameDebugging__enabled="false",
        spark__driver__memory="8g",
        spark__driver__host="127.0.0.1",
        spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_left():
    """Temporary views belong to no database, so the next module's tests would find them in every one."""
    yield
    session = SparkSession.getActiveSession()
    if session:
        for row in session.sql("SHOW TABLES").where("isTemporary").collect():
            session.catalog.dropTempView(row["tableName"])
