import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quillspan.session import local_session, ship

    session = local_session(4, memory="6g")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
