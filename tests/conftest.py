import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skygauge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions=4,
                            spark__driver__memory="4g", spark__checkpoint__dir=folder)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ntz(spark):
    """DataFrame of rows whose ``*_timestamp``/``datetime`` text columns become zone-less timestamps."""
    from pyspark.sql import functions as F

    def build(rows, ddl):
        df = spark.createDataFrame(rows, ddl.replace("TIMESTAMP_NTZ", "STRING"))
        names = [part.split()[0] for part in ddl.split(", ") if part.endswith("TIMESTAMP_NTZ")]
        return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})
    return build
