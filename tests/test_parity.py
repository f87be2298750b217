"""Every registered query against its SQL on the smallest test tables."""

from pathlib import Path

import pytest

from parity.check import compare, connect
from parity.oracle import oracle_sql
from parity.queries import queries

DATA = "/root/testdata/sf0.001"

# One folder per day of six years: minutes of file handling. Their parts are
# tested on small tables; `python -m parity.check` runs them in full.
MANY_FILES = {
    "date_partitioned_orders",
    "loaded_orders_by_day",
    "published_versions",
    "full_run_sla",
    "late_reprocess",
    "streamed_silver_events",
    "incremental_marts",
    "live_timeline",
}

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


def test_every_query_has_sql():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", [name for name in queries() if name not in MANY_FILES])
def test_query_matches_sql(spark, connection, name):
    ours = [row.asDict() for row in queries()[name](spark, DATA).collect()]
    cursor = connection.execute(oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    theirs = [dict(zip(columns, row)) for row in cursor.fetchall()]
    assert compare(ours, theirs) == ""
