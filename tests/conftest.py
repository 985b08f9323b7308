import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmill.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "starmill-tests", **{"spark.log.level": "ERROR"})


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    before = {}

    def set_options(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_options
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows(df, *order):
    """All rows as tuples, sorted."""
    got = [tuple(r) for r in df.select(*(order or df.columns)).collect()]
    return sorted(got, key=lambda r: tuple((v is not None, v) for v in r))
