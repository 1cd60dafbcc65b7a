import pytest

from faultline.session import CHECKPOINT_CONF, build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            CHECKPOINT_CONF: str(shared),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def plan_of():
    """Text of the physical plan."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
