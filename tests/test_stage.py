"""Tables between stages: where they are written, names that don't clash, and joins with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from tidewire.plans import stage


class Conf:
    def __init__(self, master, named=None):
        self.master, self.named, self.applicationId = master, named, "x"
        self.sparkContext = self

    def getConf(self):  # noqa: N802
        return {"spark.checkpoint.dir": self.named} if self.named else {}


def test_shared_folder():
    assert stage.shared_dir(Conf("yarn", "hdfs://n/shared/")) == "hdfs://n/shared"
    assert stage.shared_dir(Conf("local[4]")) == stage.shared_dir(Conf("local[4]"))
    for master in ("yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            stage.shared_dir(Conf(master))


def test_names(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4)], "`a.b` int, Row int, row_ int, `x``y` int")
    assert stage.spare_name(frame, "row") == "row__" and stage.spare_name(frame, "n") == "n"
    assert tuple(frame.select(stage.own_columns(frame)).first()) == (1, 2, 3, 4)


@pytest.mark.parametrize(("hot_rows", "hot_keys"), [(256, 4096), (3, 10), (0, 10**9)])
def test_sums_of_hot_keys(spark, hot_rows, hot_keys):
    draw = random.Random(1)
    rows = [(draw.choice([1, 1, 1, draw.randrange(50)]), k) for k in range(400)] + [(None, -1)]
    frame = spark.createDataFrame(rows, "key int, v int")
    sums = stage.written(frame.filter("key > 0").groupBy("key").agg(F.count("*").alias("n"), F.max("v").alias("most")), "sums")
    found = sorted(map(str, stage.with_sums(frame, sums, "key", hot_rows=hot_rows, hot_keys=hot_keys).collect()))
    most = {}
    for k, v in rows:
        if k:
            most[k] = max(v, most.get(k, v))
    assert found == sorted(f"Row(key={k}, v={v}, most={most.get(k)})" for k, v in rows)


@pytest.mark.parametrize("at_most", [100_000, 0])
def test_small_tables(spark, monkeypatch, at_most):
    monkeypatch.setattr(stage, "SMALL_ROWS", at_most)
    joined = stage.join_small(spark.range(5).withColumnRenamed("id", "k"), spark.createDataFrame([(1, "a")], "k long, v string"), ["k"])
    assert sorted((r["k"], r["v"] or "") for r in joined.collect()) == [(0, ""), (1, "a"), (2, ""), (3, ""), (4, "")]


def test_tables_on_the_way_are_dropped(spark):
    seen = []

    def make():
        seen.append(stage.written(spark.range(3), "inner"))
        seen.append(stage.settled(spark, lambda: stage.written(seen[0].filter("id > 0"), "deeper"), "settled"))
        return seen[1].withColumn("x", F.lit(1))

    kept = stage.settled(spark, make, "kept")
    assert kept.count() == 2 and not stage._SCOPES
    for gone in seen:
        with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST"):
            gone.collect()
    with pytest.raises(ZeroDivisionError):
        stage.settled(spark, lambda: 1 / 0, "broken")
    assert not stage._SCOPES


def test_rows_at_once(spark):
    """Whole texts go to Python in small batches, and the session's own size stands again afterwards."""
    import pyarrow as pa

    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)
    rows = spark.range(0, 3500, 1, 1).mapInArrow(sizes, "n long")
    assert sorted(r.n for r in stage.written(rows, "sizes", 1000).collect()) == [500, 1000, 1000, 1000] and spark.conf.get(conf) == before
    with pytest.raises(ZeroDivisionError), stage.rows_at_once(spark, 10):
        assert spark.conf.get(conf) == "10"
        raise ZeroDivisionError
    assert spark.conf.get(conf) == before
