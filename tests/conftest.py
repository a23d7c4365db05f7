import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from jobloom import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = build_session("tests", cores=4, warehouse=warehouse,
                            extra={"spark.sql.shuffle.partitions": "2",
                                   "spark.default.parallelism": "2"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
