import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from argent.session import get_session  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="argent-warehouse-")
    s = get_session("local[*]", app_name="argent-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
