import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loglens.plans import lifecycle as LC  # noqa: E402
from loglens.session import get_spark  # noqa: E402
from loglens.sources import tables as TB  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_small():
    """Folder of the smallest tables (a fixture: other folders have a conftest of their own)."""
    return SF_SMALL


@pytest.fixture(scope="session")
def spark():
    s = get_spark("loglens-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def trained(spark, tmp_path_factory):
    """(logs, folder of the three detectors' models of the first 20 days)."""
    root = str(tmp_path_factory.mktemp("models"))
    logs = TB.logs(spark, SF_SMALL)
    assert LC.train_all(logs, root, "2024-01-20 00:00:00", 20 * 1440) == {LC.FOREST: 1, LC.SEQUENCE: 1, LC.MESSAGE: 1}
    return logs, root
