"""Plans that must stay as they are: what scans read, and that nothing is crossed."""

import os
import re

import pytest

from griyaflow.plans import core_problems
from griyaflow.plans.base import house_view
from griyaflow.runtime import table
from tests.compare import FOLDER

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")


def read_schemas(df) -> list[str]:
    return re.findall(r"ReadSchema: (\S+)", plan_of(df))


def test_latest_rows_read_paths_only(spark):
    (schema,) = read_schemas(core_problems._latest(spark, FOLDER, "sample_15", "rec_id"))
    assert "images:array<struct<image_path:string>>" in schema and "source_group_id" not in schema


def test_house_view_reads_what_is_asked(spark):
    (schema,) = read_schemas(house_view(spark, FOLDER).groupBy("house_type", "atap").count())
    assert schema == "struct<images:array<struct<view_type:string,material_atap:string>>>"


def test_flat_tables_are_one_scan_without_exchange(spark):
    plan = plan_of(core_problems.p2_found(spark, FOLDER))
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_filters_reach_the_scan(spark):
    plan = plan_of(table(spark, FOLDER, "orders").filter("o_orderkey > 10").select("o_custkey"))
    assert "GreaterThan(o_orderkey,10)" in plan and "o_totalprice" not in plan
