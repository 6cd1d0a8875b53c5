import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session
    s = build_session("local[4]", 4, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()
