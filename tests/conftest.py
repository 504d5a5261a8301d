import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import checkpoint_dir, get_spark
    import tempfile
    s = get_spark("local[4]", app_name="tessera-tests", shuffle_partitions=4,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tessera-wh-")})
    checkpoint_dir(s)  # registers a folder only when the session has none
    yield s


@pytest.fixture()
def ts():
    import datetime as dt

    def make(s: str):
        return dt.datetime.fromisoformat(s)
    return make
