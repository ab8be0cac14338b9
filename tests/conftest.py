import pytest

from hazeline.session import local_session
from panels import raw_pandas, to_spark


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", "tests", shuffle_partitions=4)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw():
    return raw_pandas()


@pytest.fixture(scope="session")
def raw_df(spark, raw):
    return to_spark(spark, raw).cache()


@pytest.fixture(scope="session")
def engineered_df(raw_df):
    from hazeline.operators.features import add_features
    from hazeline.session import written

    return written(add_features(raw_df), "engineered")
