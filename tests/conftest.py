import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from humusgrid import get_session

    session = get_session("local[4]", 4, **{"spark.sql.warehouse.dir": "/tmp/humusgrid-warehouse", "spark.driver.memory": "4g"})
    yield session
    session.stop()
