"""Queries on a cluster whose executors are processes of their own, against the same in one process."""

import json
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

from conftest import HERE, SF

NAMES = ["scan_jdbc", "scan_jdbc_pushdown", "snapshot_jdbc_ordered", "sink_jdbc_merge", "snapshot_jdbc_ranges", "scan_jdbc_partitioned", "sink_jdbc_merge_ignore_null", "table_by_options"]
SCRIPT = """
import json, os, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "700m").config("spark.driver.host", "127.0.0.1")
    .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
    .config("spark.checkpoint.dir", "file://" + sys.argv[3]).getOrCreate()
)
import __spark_entry__ as entry
for name in sys.argv[4:]:
    try:
        found = sorted(repr(tuple(r)) for r in entry.queries()[name](spark, sys.argv[2]).collect())
    except Exception as e:
        found = str(e)[:300]
    print("FOUND", json.dumps([name, found]), flush=True)
spark.stop()
"""


@pytest.fixture(scope="module")
def on_cluster(tmp_path_factory):
    folder = tmp_path_factory.mktemp("cluster")
    env = os.environ | {"PYTHONPATH": HERE, "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_LOCAL_DIRS": str(folder / "local")}
    said = subprocess.run([sys.executable, "-c", SCRIPT, HERE, SF, str(folder / "shared"), *NAMES], env=env, cwd=folder, capture_output=True, text=True, timeout=300)
    return dict(json.loads(x.removeprefix("FOUND ")) for x in said.stdout.splitlines() if x.startswith("FOUND "))


@pytest.mark.parametrize("name", NAMES)
def test_same_on_a_cluster(spark, on_cluster, name):
    """An embedded database is out of the executors' reach."""
    assert on_cluster.get(name) == sorted(repr(tuple(r)) for r in entry.queries()[name](spark, SF).collect())


BY_DRIVER = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = (
    SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.executor.memory", "700m").config("spark.driver.host", "127.0.0.1").config("spark.driver.memory", "460m")
    .config("spark.ui.enabled", "false").config("spark.driver.maxResultSize", "0").config("spark.checkpoint.dir", "file://" + sys.argv[2]).getOrCreate()
)
from tidewire.functions.options import JdbcOptions
from tidewire.sources import jdbc
url = f"jdbc:derby:{sys.argv[2]}-database;create=true"
rows = spark.range(0, 130_000, 1, 1).select(F.col("id").alias("ID"), F.concat(F.lit("x" * 3_500), "id").alias("TEXT"))
jdbc.append(rows, JdbcOptions(url=url, table_name="wide", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver"))
told = spark._jvm.java.sql.DriverManager.getConnection(url).createStatement().executeQuery("SELECT COUNT(*), MIN(ID), MAX(ID) FROM wide")
told.next()
print("FOUND", [told.getLong(k) for k in (1, 2, 3)], flush=True)
spark.stop()
"""


def test_driver_does_not_hold_a_partition(tmp_path):
    """A partition of some 450 MB, by a driver of 460 MB."""
    env = os.environ | {"PYTHONPATH": HERE, "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_LOCAL_DIRS": str(tmp_path / "local")}
    said = subprocess.run([sys.executable, "-c", BY_DRIVER, HERE, str(tmp_path / "shared")], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert [x for x in said.stdout.splitlines() if x.startswith("FOUND")] == ["FOUND [130000, 0, 129999]"]
