import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from compare import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session()
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("stages")))
    yield session
    session.stop()


@pytest.fixture
def column_values(spark):
    """Values of a column function over texts, in input order."""

    def run(function, texts, *more):
        from pyspark.sql import functions as F

        rows = [(i, *values) for i, values in enumerate(zip(texts, *more))]
        names = ["t" + str(i) for i in range(1 + len(more))]
        df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} string" for n in names))
        out = df.select("i", function(*[F.col(n) for n in names]).alias("v"))
        return [r.v for r in sorted(out.collect(), key=lambda r: r.i)]

    return run
