import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from gamelake.session import get_spark
    s = get_spark("local[4]", app="gamelake-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=lambda t: tuple(str(x) for x in t))


def plan_text(df, execute=True):
    """The physical plan as printed by the public ``explain()`` (final AQE plan once executed)."""
    import contextlib
    import io
    if execute:
        df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
