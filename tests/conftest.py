import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from newsloom.session import local_session

    root = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        "newsloom-tests",
        **{
            "spark.checkpoint.dir": str(root / "checkpoint"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={root}",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
