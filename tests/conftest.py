import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tests.session import make_session

    return make_session()


@pytest.fixture(scope="session")
def make(spark):
    """Rows with an id: make(X, y) -> id, x0.., y and the array column x."""
    import numpy as np
    from pyspark.sql import functions as F

    def build(x, y=None):
        x = np.asarray(x, dtype=float)
        names = [f"x{j}" for j in range(x.shape[1])]
        y = np.zeros(len(x)) if y is None else y
        rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
        df = spark.createDataFrame(rows, "id long, " + "".join(f"{n} double, " for n in names) + "y double")
        return df.withColumn("x", F.array(*names))

    return build
