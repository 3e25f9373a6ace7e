import pytest

from rostrum.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.streaming.noDataMicroBatches.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema -> DataFrame."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def value(spark):
    """Evaluate a column of one literal text."""
    from pyspark.sql import functions as F

    def run(make, *texts):
        row = spark.range(1).select(make(*[F.lit(t).cast("string") for t in texts]).alias("v")).first()
        return row["v"]

    return run
