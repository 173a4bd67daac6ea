from __future__ import annotations

import pytest

from citeloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, memory="3g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
