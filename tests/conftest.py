import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skyfold.session import get_spark
    from skyfold.session import checkpoint_dir
    s = get_spark("local[4]", app="skyfold-tests", shuffle_partitions=4)
    checkpoint_dir(s)          # the configured folder, or a local one when none is set
    yield s
    s.stop()


@pytest.fixture(scope="session")
def seed(spark):
    from skyfold.sources.seed import SeedModel
    return SeedModel(spark, "2026-03-02")
