from keelson.sources.tables import spread


def test_spread_only_when_fewer_splits_than_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == cores                  # single split: spread
    assert spread(one, size_hint=10).rdd.getNumPartitions() == 1        # tiny file: left alone
    many = spark.range(0, 1000, numPartitions=cores * 2)
    assert spread(many).rdd.getNumPartitions() == cores * 2             # already parallel: no-op
    assert spread(one).count() == 1000
