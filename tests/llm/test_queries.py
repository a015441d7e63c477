import os

import pytest

from griyaflow.llm import catalogue
from tests.compare import FOLDER, check, database

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database()


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_against_sql(spark, con, name):
    check(spark, con, catalogue.queries()[name], catalogue.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_runs(spark, name):
    assert catalogue.queries()[name](spark, FOLDER).count() > 0
