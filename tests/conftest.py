import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from docsift.session import build_session

    warehouse = tempfile.mkdtemp(prefix="docsift-wh-")
    s = build_session("local[4]", 4, extra={
        "spark.sql.warehouse.dir": warehouse,
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='docsift-ckpt-')}",
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
