"""Tables that were written leave no shuffle files behind."""

import threading

import pytest
from pyspark.sql import functions as F

from shoptrail import session


def known_shuffles(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def shuffle_bytes(spark):
    """Of the blocks of shuffles in this process's block manager."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = disk.getAllFiles()
    names = [found.apply(i) for i in range(found.size())]
    return sum(f.length() for f in names if f.getName().startswith("shuffle_"))


@pytest.mark.parametrize("write", [session.materialize, session.stored])
def test_a_written_table_leaves_no_shuffle_files(spark, write):
    counts = spark.range(50_000).groupBy((F.col("id") % 20_011).alias("k")).count()
    frame = counts.join(spark.range(20_011).withColumnRenamed("id", "k").repartition("k"), "k")
    before = shuffle_bytes(spark)
    made = write(frame)
    assert shuffle_bytes(spark) <= before
    assert made.count() == 20_011 and made.agg(F.sum("count")).first()[0] == 50_000
    assert frame.count() == 20_011  # the frame itself can still run


def test_threads_that_write_restore_the_setting(spark):
    before = spark.conf.get(session._CLEANUP)
    inside = threading.Barrier(2)

    def write(last):
        with session.passing_shuffles(spark):
            inside.wait(30)
            if last:
                assert spark.conf.get(session._CLEANUP) == "true"
        inside.wait(30)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(2)]
    [t.start() for t in threads]
    [t.join(60) for t in threads]
    assert spark.conf.get(session._CLEANUP) == before and not session._writing
