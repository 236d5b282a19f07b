from __future__ import annotations

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gleaner.session import local_session  # noqa: E402

DATA = os.environ.get("GLEANER_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session


@pytest.fixture(scope="session")
def data() -> str:
    if not os.path.isdir(DATA):
        pytest.skip(f"no tables at {DATA}")
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    """A value as text that is the same for both engines."""
    if v is None or v != v:
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


@pytest.fixture(scope="session")
def same(spark, data, duck):
    """Compares a query with its SQL, whatever the order of rows and columns."""

    def compare(query, sql: str) -> None:
        df = query(spark, data)
        cols = sorted(df.columns)
        mine = sorted("|".join(plain(r[c]) for c in cols) for r in df.collect())
        got = duck.execute(sql)
        names = [x[0] for x in got.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        theirs = sorted("|".join(plain(r[i]) for i in at) for r in got.fetchall())
        assert mine == theirs

    return compare
