"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest
from oracle import duck, mismatch
from plan import static_plan

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__  # noqa: E402
from vanescope import workload  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no sample tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(workload.QUERIES))
def test_query_equals_sql(spark, connection, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    assert mismatch(df, connection, __spark_entry__.oracle_sql()[name]) is None
    assert "Python" not in static_plan(df)


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
