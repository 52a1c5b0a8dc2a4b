import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": str(folder / "checkpoints"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    yield session
    session.stop()
