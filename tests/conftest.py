import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from watchfold.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="watchfold-tests", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wf-test-wh-"),
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)     # keeps a configured folder; a scratch one only if unset
    yield session
    session.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()),
                  key=lambda t: tuple((v is not None, v if v is not None else 0) for v in t))


LOG_SCHEMA = "Contract string, Mac string, AppName string, TotalDuration bigint, log_date date"
