import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crowdscope.session import build_session, shared_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    s = build_session("local[*]", app="crowdscope-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="crowdscope-wh-")})
    shared_dir(s)
    yield s
    s.stop()
