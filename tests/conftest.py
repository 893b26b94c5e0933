import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kinesia.session import checkpoint_root, local_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8)
    checkpoint_root(session)  # sets a local folder only if spark.checkpoint.dir is unset
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SMOKE}/events.parquet")
