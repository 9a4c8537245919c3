import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tiffin.session import build_session
    session = build_session("tests", cores=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bronze(spark):
    from tiffin.sources.bronze import Bronze
    return Bronze(spark, DATA)
