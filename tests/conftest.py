import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_spark

    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, tmp_path_factory):
    """A fresh folder under the session's checkpoint root for each test that writes."""
    import uuid

    from strata.session import checkpoint_root

    return f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}"
