import pytest

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_tasks(spark):
    """Make every key of more than 20 rows large, so that sequences are cut."""
    spark.conf.set("spark.millrace.rowsPerTask", "20")
    yield
    spark.conf.unset("spark.millrace.rowsPerTask")
