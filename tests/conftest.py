import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import get_session
    s = get_session(app="daybook-tests", master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def root(spark):
    from daybook.session import scratch_dir
    return scratch_dir(spark, "test")


def write_csv(path_dir: str, name: str, text: str) -> str:
    from daybook.session import local_path
    d = local_path(path_dir)
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p
