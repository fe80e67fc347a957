import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hydromart.session import build_session
    s = build_session("local[4]", 4, app_name="hydromart-tests",
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted tuples of the selected columns."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
