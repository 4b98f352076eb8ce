import pytest

from zonewright.session import build_session

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        **{
            "spark_sql_shuffle_partitions": "8",
            "spark_sql_warehouse_dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark_checkpoint_dir": str(tmp_path_factory.mktemp("shared")),
            "spark_ui_showConsoleProgress": "false",
            "spark_driver_memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
