import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("smudgelex-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tokens_of(spark):
    """Tokens of many strings in one job: list of lists of rows."""
    from smudgelex.functions.tokens import token_array

    def run(texts, markup="none", numeric="drop", tags=False, final=False):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
        array = token_array("s", markup, numeric, tags, final).alias("a")
        rows = df.select("i", array).collect()
        return [r.a for r in sorted(rows, key=lambda r: r.i)]

    return run
