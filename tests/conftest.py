import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from quakespark.session import local_session

    # tiny inputs: compiling a plan costs more than running it, so the tests interpret
    session = local_session(
        "4", "quakespark-tests",
        **{"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
           "spark.sql.shuffle.partitions": "2"},
    )
    yield session
    session.stop()
