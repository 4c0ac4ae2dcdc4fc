import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("TIDEMARK_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session("8", "tidemark-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(DATA).glob("*.parquet")):
        source = path if path.is_file() else path / "*.parquet"
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{source}'")
    return con


@pytest.fixture(scope="session")
def data():
    return DATA
