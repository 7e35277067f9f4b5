import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from factloom.session import local_session, ship

    shared = tmp_path_factory.mktemp("shared")
    s = local_session("4", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    return s
