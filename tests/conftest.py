import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from farebox.session import local_session
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    s = local_session("*", shuffle_partitions=8, app_name="farebox-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()

    def for_dir(sf_dir):
        for t in ["lineitem", "events", "supplier", "nation"]:
            con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return for_dir


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
