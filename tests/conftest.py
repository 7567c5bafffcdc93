import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from casekit.session import checkpoint_dir, get_session

    s = get_session("local[4]", app_name="casekit-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(autouse=True, scope="module")
def _own_cache(spark):
    """Tables a module cached must not stand in for the next one's plans."""
    yield
    spark.catalog.clearCache()
