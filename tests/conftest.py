import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from postloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[8]", "tests", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a column function to a list of texts; returns the results in order."""
    def run(values, function):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        from pyspark.sql import functions as F

        result = rows.select("i", function(F.col("v")).alias("r")).collect()
        return [r["r"] for r in sorted(result, key=lambda r: r["i"])]

    return run


def tables(scale="sf0.001"):
    folder = f"/root/testdata/{scale}"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    return folder
