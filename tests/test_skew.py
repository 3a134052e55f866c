from pyspark.sql import functions as F

from echowire.operators.skew import attach


def _rows(spark):
    """A third of the rows share key 0, others key 1, which the table lacks, or have no key."""
    key = (
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, 1)
        .when(F.col("id") % 5 == 2, None).otherwise(F.col("id"))
    )
    return spark.range(3000).select("id", key.cast("long").alias("k"))


def test_attach_equals_plain_join(spark):
    rows = _rows(spark)
    table = spark.range(0, 6000, 2).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    for how in ("inner", "left"):
        expected = sorted(map(tuple, rows.join(table, "k", how).select("id", "k", "v").collect()), key=str)
        for hot in (1, 2, 1000):
            got = attach(rows, table, ["k"], ["id"], how=how, hot_keys=hot)
            assert got.columns == ["id", "k", "v"]
            assert sorted(map(tuple, got.collect()), key=str) == expected


def test_no_shuffle_partition_is_filled_by_one_key(spark):
    rows = _rows(spark)
    table = spark.range(0, 6000, 2).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    saved = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for name, value in zip(saved, ("-1", "false")):
            spark.conf.set(name, value)
        joined = attach(rows, table, ["k"], ["id"], how="left", hot_keys=2)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in saved.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 3000
    assert max(sizes) < 1.3 * 3000 / 4


def test_frequencies_from_table_column(spark):
    rows = _rows(spark)
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = attach(rows, groups, ["k"], ["id"], size="n", hot_keys=1)
    expected = rows.join(groups, "k").select("id", "k", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
