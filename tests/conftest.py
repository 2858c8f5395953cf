import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from venturelens.session import build_session

    session = build_session(
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def values(spark, column, *texts):
    """Results of ``column(F.col("x"))`` over the given texts, in order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]
