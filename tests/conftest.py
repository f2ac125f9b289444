import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from martworks.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="martworks-warehouse-")
    s = get_session("local[4]", 8, extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
