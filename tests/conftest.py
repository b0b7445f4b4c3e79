import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kindred.session import build_session

    import __spark_entry__ as entry

    session = build_session(
        "tests", "local[8]", spark_sql_shuffle_partitions="4", spark_driver_memory="4g",
        spark_ui_showConsoleProgress="false",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    entry._ship(session)
    yield session
    session.stop()


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def ts(text):
    return dt.datetime.fromisoformat(text)
