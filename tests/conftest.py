import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from derrick.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", app_name="derrick-tests", shuffle_partitions=4,
                      extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ckpt-"),
                                  "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wh-")})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="derrick-test-")


def rows(df, *order):
    """Collected rows as plain tuples, sorted."""
    cols = df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t))
