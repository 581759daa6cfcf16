import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from clickrate.session import get_session

    scratch = tempfile.mkdtemp(prefix="clickrate-tests-")
    s = get_session("local[4]", app_name="clickrate-tests", shuffle_partitions=4,
                    **{"spark.checkpoint.dir": scratch})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
