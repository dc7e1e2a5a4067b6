import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from mercato.session import build_session

    warehouse = tempfile.mkdtemp(prefix="mercato-wh-")
    s = build_session(
        "local[*]", app_name="mercato-tests", shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="mercato-test-", dir=os.environ.get("TMPDIR", "/tmp"))
