import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakewright.session import build_session
    wh = tempfile.mkdtemp(prefix="lakewright-test-wh-")
    s = build_session("local[4]", app_name="lakewright-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path(tmp_path):
    return str(tmp_path)
