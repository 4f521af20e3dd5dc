"""Tables of few bytes that become wide rows use all cores, however few row groups or partitions they come in."""

import __spark_entry__ as entry  # noqa: F401 (puts the repository on the path)
from tallyward.plans import catalog_queries as c


def test_parts_of_one_row_group_reach_every_core(spark):
    rows = c.rows_of(spark, "/root/testdata/sf0.01", {"x": "k + 1"})
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
