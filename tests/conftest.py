import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starflow.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    wh = tempfile.mkdtemp(prefix="starflow-test-wh-")
    s = get_session("local[4]", app="starflow-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": wh})
    # tests name their own shared folder; a cluster names it in spark.checkpoint.dir
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="starflow-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


def rows(df, order=None):
    if order:
        df = df.orderBy(*order)
    return [tuple(r) for r in df.collect()]
