import time

from pyspark.sql import functions as F

from lakekit.llm.common import SHUFFLE_CLEANUP, staged


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_of_a_staged_table_go_with_its_write(llm):
    before, conf = shuffle_files(llm), llm.conf.get(SHUFFLE_CLEANUP, None)
    table = staged(llm.range(5000).groupBy((F.col("id") % 700).alias("k")).count(), "cleaned")
    until = time.time() + 20
    while shuffle_files(llm) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(llm) - before
    assert table.count() == 700 and llm.conf.get(SHUFFLE_CLEANUP, None) == conf
