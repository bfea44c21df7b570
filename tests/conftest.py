import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Build a frame of text columns from rows of dicts; absent cells are NULL."""

    def make(rows, columns=None):
        columns = columns or list(dict.fromkeys(c for r in rows for c in r))
        schema = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)

    return make


@pytest.fixture
def listing():
    """One complete listing row, with changes."""

    def make(key="app.one", **changes):
        row = {
            "bundle_id": key,
            "description": "A plain text",
            "summary": "An app for all",
            "genreid": "TOOLS",
            "content_rating": "Everyone",
            "score": "4.5",
            "ratings_count": "1000",
            "installs": "1,000,000+",
            "developerid": "d1",
            "developer": "Dev",
            "free": "True",
            "offers_iap": "no",
            "days_since_released": "400",
        }
        return row | changes

    return make
