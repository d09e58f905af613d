from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from clickmart.session import build_session  # noqa: E402
from clickmart.sources import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import tempfile
    wh = tempfile.mkdtemp(prefix="clickmart-wh-")
    s = build_session("local[*]", app="clickmart-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def at(minutes: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes)


def frame(spark, feed: str, rows: list[dict]):
    """A feed DataFrame from partial dicts (missing columns are NULL)."""
    schema = schemas.FEED_SCHEMAS[feed]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
