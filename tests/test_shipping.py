import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
from frameml.operators import mixture as G, neural as N, solvers
df = spark.range(40).select("id", F.array((F.col("id") % 7).cast("double"), (F.col("id") % 5) * 1.0).alias("x"),
                            (F.col("id") % 2).alias("y"))
net = N.mlp_fit(df, ("x", 2), "y", hidden=[3], epochs=1)
assert N.mlp_predict(df, N.mlp(2, [40, 40, 1]), ("x", 2)).count() == 40
G.MAX_LITERAL_TERMS = 1
model = G.gmm_fit(df, ("x", 2), 2, 1, init=[[0.0, 0.0], [5.0, 3.0]])
assert G.gmm_predict(df, model, ("x", 2)).groupBy("component").count().count() >= 1
assert solvers.linear_fit_by_group(df, "y", ("x", 2), "y", reg=1.0).count() == 2
print("shipped")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Workers start in a folder from which frameml cannot be imported."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", SCRIPT, root], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=240)
    assert "shipped" in got.stdout, got.stderr[-2000:]
