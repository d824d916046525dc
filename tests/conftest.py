import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hiresight.session import local_session

    s = local_session("*", 8, extra={"spark.ui.showConsoleProgress": "false"})
    yield s


def one(spark, col, value, schema="x string"):
    """Evaluate a column expression on a one-row frame with column ``x``."""
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def many(spark, col, values, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, " + schema)
    return [r["r"] for r in df.select("i", col.alias("r")).orderBy("i").collect()]


def scratch_dir(prefix="scratch-"):
    return tempfile.mkdtemp(prefix=prefix)
