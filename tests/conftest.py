import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        app="tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to a list of texts and return the list of results."""

    def apply(function, cells):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(cells)), "i int, c string")
        rows = df.select("i", function(F.col("c")).alias("r")).collect()
        return [r.r for r in sorted(rows, key=lambda r: r.i)]

    return apply
