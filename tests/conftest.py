from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from formfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Typed documents from Python dicts, read the way JSON bytes are."""
    from formfold.sources import records

    def make(schema: str, *items: dict):
        raw = spark.createDataFrame([(json.dumps(i).encode(),) for i in items], "value binary")
        return records(raw, schema).drop("_raw", "_bad")

    return make
