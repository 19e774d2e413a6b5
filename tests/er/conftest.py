import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "2")
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


RAW = "id string, prod_name string, brand string, category string, description string, specs string, img_links string, url string, created_at string, updated_at string, retailer string, price string, sku string, dimension string, label string"


@pytest.fixture(scope="session")
def offers_of(spark):
    """Raw rows from dicts; what is not named is empty."""
    names = [c.split()[0] for c in RAW.split(", ")]

    def make(*rows):
        return spark.createDataFrame([tuple(r.get(c, None if c == "label" else "") for c in names) for r in rows], RAW)

    return make
