import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarterline.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    warehouse = tempfile.mkdtemp(prefix="quarterline-warehouse-")
    s = local_session("*", app="quarterline-tests", **{"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
