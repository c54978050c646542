from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from storeledger.session import build_session  # noqa: E402

HEADER = "order_id,customer_id,product_id,order_date,quantity,unit_price,payment_status"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("work")
    session = build_session(
        "tests",
        "local[*]",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(work),
        spark__sql__warehouse__dir=str(work / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def store_file(folder: Path, name: str, *lines: str, header: str = HEADER, end: str = "\n") -> Path:
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(end.join([header, *lines, ""]).encode("utf-8"))
    return path


def by_file(rows) -> dict:
    """Rows keyed by the last segment of their source key."""
    return {r["source_key"].rsplit("/", 1)[-1]: r for r in rows}
