import pytest

from merch.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "merch-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    yield session
    session.stop()
