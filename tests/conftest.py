import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from topicgrove.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("topicgrove-tests", 4, **{"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})


@pytest.fixture(scope="session")
def column(spark):
    """Values of one expression over a list of texts."""

    def evaluate(texts, function):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        found = rows.select("i", function(F.col("t")).alias("x")).orderBy("i").collect()
        return [r.x for r in found]

    return evaluate
