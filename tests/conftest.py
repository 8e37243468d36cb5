import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from hourgrid.session import local_session  # noqa: E402

os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(8, "tests", **{"spark.checkpoint.dir": str(shared), "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def obs(spark):
    """Observations from (time text, latitude, longitude, temperature, precipitation) tuples."""

    def make(rows):
        schema = (
            "time timestamp_ntz, latitude double, longitude double, temperature_c double, precipitation_mm double"
        )
        parsed = [(dt.datetime.fromisoformat(t), *rest) for t, *rest in rows]
        return spark.createDataFrame(parsed, schema)

    return make
