import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])
DATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import session

    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    found = session(
        "tests", master="local[4]", shuffle_partitions=4,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.sql.codegen.cache.maxEntries": "500"},
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.001"
