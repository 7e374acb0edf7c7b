import pytest
from pyspark.sql import SparkSession

from catalogue.harness import with_shared_folder


def local_session(cores: str = "8") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tarmac")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return with_shared_folder(session)


@pytest.fixture(scope="session")
def spark():
    return local_session()
