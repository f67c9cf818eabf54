"""Session and object-store settings."""

from txguard import workspace
from txguard.session import object_store_conf


def test_credentials_come_from_the_environment_only():
    assert not any("key" in k for k in object_store_conf({}))
    conf = object_store_conf({"AWS_ACCESS_KEY_ID": "id", "AWS_SECRET_ACCESS_KEY": "secret",
                              "OBJECT_STORE_ENDPOINT": "http://store:9000"})
    assert conf["spark.hadoop.fs.s3a.access.key"] == "id"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert object_store_conf({"OBJECT_STORE_ENDPOINT": "https://store"})[
        "spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_working_tables_lie_in_the_shared_folder(spark):
    path = workspace.new_path(spark, "x")
    assert path.startswith(workspace.shared_root(spark)) and path != workspace.new_path(spark, "x")


def test_worker_functions_run_without_the_package(tmp_path):
    """Executors have Spark, pandas and numpy, but not this package."""
    import subprocess
    import sys
    from collections import deque

    from pyspark import cloudpickle

    from txguard.operators.velocity import decide
    from txguard.plans.anomaly import _grow

    blob = cloudpickle.dumps((decide, _grow(["x"], 2, 1), deque([(0, 1)])))
    code = (
        "import pickle, sys, pandas as pd\n"
        "import numpy as np\n"
        "decide, grow, recent = pickle.loads(sys.stdin.buffer.read())\n"
        "nodes = grow(pd.DataFrame({'tree': [0, 0], 'x': [1.0, 2.0]}))\n"
        "print(decide(recent, np.array([10]), np.array([5]), 3, 60)[0][0], len(nodes), 'txguard' in sys.modules)")
    done = subprocess.run([sys.executable, "-c", code], input=blob, capture_output=True, cwd=tmp_path, check=True)
    assert done.stdout.decode().split() == ["2", "3", "False"]
