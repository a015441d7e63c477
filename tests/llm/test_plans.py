import os

import pytest

from griyaflow.llm import canonical, overlap
from griyaflow.runtime import table
from tests.compare import FOLDER
from tests.test_plans import plan_of, read_schemas

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")


def test_pictures_read_hashes_only(spark):
    df = overlap.picture_hashes(table(spark, FOLDER, "sample_15"), table(spark, FOLDER, "placeholder_hashes"))
    assert "struct<rec_id:bigint,split:string,images:array<struct<image_hash:string>>>" in read_schemas(df)
    assert "CartesianProduct" not in plan_of(df)


def test_mentions_read_materials_only(spark):
    (schema,) = read_schemas(canonical.material_mentions(table(spark, FOLDER, "sample_15")))
    assert schema == "struct<rec_id:bigint,images:array<struct<material_atap:string,material_dinding:string,material_lantai:string>>>"
