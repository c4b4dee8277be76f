import pytest

from patentloom.session import CHECKPOINT_KEY, get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            CHECKPOINT_KEY: str(root / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    """The physical plan of a DataFrame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    """Rows as plain sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(name="rows")
def rows_fixture():
    return rows
