import time

from geoindicators.llm.common import CLEANUP, table


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    rows = spark.range(20_000).selectExpr("id", "id % 7 as k").repartition(4, "id")
    written = table(rows.groupBy("k").count(), "counts")
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(CLEANUP) == setting
    assert written.agg({"count": "sum"}).first()[0] == rows.count() == 20_000
