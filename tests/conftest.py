import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("vertexloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_graph(spark):
    from vertexloom.operators import graph_from_edges

    def make(pairs, directed=True, **kwargs):
        rows = [(a, b, 1.0) for a, b in pairs]
        return graph_from_edges(
            spark.createDataFrame(rows, "src string, dst string, weight double"), directed=directed, **kwargs
        )

    return make
