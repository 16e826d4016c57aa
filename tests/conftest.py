import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pulsemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("4", shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Documents of user 7, one per content, named doc0, doc1, ..."""

    def make(*contents):
        rows = [
            (f"doc{i}", c if isinstance(c, str) else json.dumps(c), 7) for i, c in enumerate(contents)
        ]
        frame = spark.createDataFrame(rows, "file_name string, content string, user_id bigint")
        return frame.selectExpr("timestamp'2025-01-01 12:00:00' as file_set_ts", "1 as type_rank", "*")

    return make


@pytest.fixture
def table():
    """Rows of a frame as sorted tuples."""

    def rows(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return rows


@pytest.fixture
def raw(spark):
    """A raw mailbox frame from a mapping of file name to content."""

    def make(files):
        rows = [
            (name, f"/in/{name}", "2025-08-07 13:00:00", 10, c if isinstance(c, str) else json.dumps(c))
            for name, c in files.items()
        ]
        frame = spark.createDataFrame(
            rows, "file_name string, path string, mtime string, length bigint, content string"
        )
        return frame.selectExpr("file_name", "path", "cast(mtime as timestamp) as mtime", "length", "content")

    return make
