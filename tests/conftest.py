import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from partsflow.session import get_session
    s = get_session("local[4]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="pf-ckpt-", dir="/tmp")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def rows(df):
    """Order-insensitive row multiset of a DataFrame (columns sorted by name)."""
    from collections import Counter
    cols = sorted(df.columns)
    return Counter(tuple(r) for r in df.select(*cols).collect())
