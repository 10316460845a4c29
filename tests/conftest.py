import pytest

from meterlake.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    staging = str(tmp_path_factory.mktemp("staging"))
    s = local_session("tests", **{"spark.checkpoint.dir": staging})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
