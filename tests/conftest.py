import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="quarry-test-ckpt-")})
    yield s
    s.stop()


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]
