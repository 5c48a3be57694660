import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from basketry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        **{"spark.checkpoint.dir": str(scratch / "checkpoint"), "spark.sql.warehouse.dir": str(scratch / "warehouse")},
    )
    yield session
    session.stop()
