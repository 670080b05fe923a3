import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from geodemand.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="geodemand-tests-")
    s = get_spark(
        "local[*]",
        app_name="geodemand-tests",
        shuffle_partitions=8,
        conf={"spark.local.dir": scratch, "spark.sql.warehouse.dir": f"{scratch}/warehouse"},
    )
    s.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def no_view_outlives_its_test(request):
    """Temporary views belong to the session, and listTables names them in every database."""
    yield
    if "spark" in request.fixturenames:
        s = request.getfixturevalue("spark")
        for t in s.catalog.listTables():
            if t.isTemporary:
                s.catalog.dropTempView(t.name)
