import pytest
from pyspark.sql import SparkSession

from assetlake.session import build_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.sql.streaming.stateStore.maintenanceInterval": "3600s",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
