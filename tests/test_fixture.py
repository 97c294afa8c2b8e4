"""The fixture's joined tables: joined once, whatever reads them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from gallery import fixture, stored
from tripmart.paths import raw_path, under
from tripmart.plans.staging import SERVICES
from tripmart.sources.lake import read_lake
from tripmart.session import RUNTIME, SETTINGS


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders of all services over two months. A line, a supplier and a customer come twice; some keys lack a row or a value."""
    base = str(tmp_path_factory.mktemp("tables"))
    values = {
        "region": ["select cast(id as int) r_regionkey, concat('R', id) r_name from range(2)"],
        "nation": ["select cast(id as int) n_nationkey, concat('N', id) n_name, cast(id % 2 as int) n_regionkey from range(25)"],
        "customer": ["select id c_custkey, 'c' c_name, cast(id % 25 as int) c_nationkey, 1D c_acctbal, 's' c_mktsegment from range(30)"] * 2,
        "supplier": ["select if(id = 9, null, id) s_suppkey, 's' s_name, cast(id % 25 as int) s_nationkey, 1D s_acctbal from range(12)"],
        "orders": [
            """select if(id = 5, null, id) o_orderkey, id % 33 o_custkey, 'F' o_orderstatus, 1D o_totalprice,
               timestamp_ntz'1997-01-10' + make_dt_interval(cast(id % 40 as int)) o_orderdate,
               concat(1 + id % 6, '-X') o_orderpriority from range(200)"""
        ],
        "lineitem": [
            """select if(id = 8, null, id % 210) l_orderkey, id % 500 l_partkey, if(id % 50 = 9, null, id % 14) l_suppkey,
               cast(1 + id % 7 as int) l_linenumber, 1D + id % 50 l_quantity, 100D + id l_extendedprice, 0.25D l_discount,
               0.5D l_tax, if(id % 3 = 0, 'N', 'R') l_returnflag, 'F' l_linestatus, timestamp_ntz'1997-02-01' l_shipdate
               from range(900)""",
            """select 7L l_orderkey, 7L l_partkey, 7L l_suppkey, 1 l_linenumber, 8D l_quantity, 107D l_extendedprice,
               0.25D l_discount, 0.5D l_tax, 'R' l_returnflag, 'F' l_linestatus, timestamp_ntz'1997-02-01' l_shipdate""",
        ],
        "events": ["select id event_id, timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id as int)) ts, 1L user_id, 'e' event_type, 1D value, 'p' props from range(48)"],
    }
    for name, texts in values.items():
        rows = spark.sql(" union all ".join(f"({text})" for text in texts))
        rows.write.parquet(f"{base}/{name}.parquet")
    return base


def counted(df):
    return sorted((tuple(r) for r in df.groupBy(*df.columns).count().collect()), key=repr)


@pytest.mark.parametrize("faultless", [False, True])
def test_landed_records_are_those_of_the_tables(spark, tables, faultless):
    base = stored.landed(spark, tables, faultless)
    for service in SERVICES:
        expected = fixture.raw_trips(spark, tables, service, faultless)
        found = read_lake(spark, under(base, raw_path(service))).select(expected.columns)
        assert expected.count() > 0
        assert counted(found) == counted(expected)


def test_trips_of_all_services_shuffle_no_line(spark, tables):
    plan = fixture.trips(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Scan parquet ", plan)) >= len(SERVICES)
    assert not re.search(r"lineitem\.parquet|SortMergeJoin|Exchange hashpartitioning", plan)


def test_lines_are_joined_once(spark, tables):
    first = fixture.stored_lines(spark, tables).inputFiles()
    assert first and fixture.stored_lines(spark, tables).inputFiles() == first
    orders = fixture.table(spark, tables, "orders").count()
    assert fixture.stored_lines(spark, tables).where(F.col("o_orderpriority").isNotNull()).count() > orders


def test_lines_are_used_with_the_librarys_settings(spark, tables):
    other = spark.newSession()
    for key in RUNTIME:
        other.conf.unset(key)
    other.conf.set(RUNTIME[0], "3")
    fixture.stored_lines(other, tables)
    assert [other.conf.get(key) for key in RUNTIME] == ["3", SETTINGS[RUNTIME[1]]]
