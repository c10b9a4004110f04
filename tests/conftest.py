import pytest

from headwater.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        "headwater-tests", "4", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
