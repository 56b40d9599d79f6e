import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from gridlake.session import local_session

    s = local_session(4, 4, app="gridlake-tests")
    # A DST-observing session zone on purpose: every time rule must give the
    # same answer as under UTC.
    s.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
