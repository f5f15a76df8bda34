import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from probelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Rows of a one-column frame mapped through a column expression, in order."""
    from pyspark.sql import functions as F

    def run(data, expression, kind="string"):
        numbered = [(i, v) for i, v in enumerate(data)]
        frame = spark.createDataFrame(numbered, f"i int, v {kind}")
        rows = frame.select("i", expression(F.col("v")).alias("r")).collect()
        return [r.r for r in sorted(rows, key=lambda r: r.i)]

    return run
