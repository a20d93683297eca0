from pyspark.sql import Window, functions as F

from tradewh.operators.keys import dense_keys, dense_row_ids


def test_dense_keys_match_row_number(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 100003).cast("string").alias("k")).distinct()
    got = dense_keys(df, ["k"], "key", num_partitions=6)
    expected = df.select(F.row_number().over(Window.orderBy("k")).alias("key_x"), "k")
    joined = got.join(expected, "k")
    assert got.count() == df.count()
    assert joined.where(F.col("key") != F.col("key_x")).count() == 0
    assert got.agg(F.min("key"), F.max("key")).first() == (1, df.count())


def test_dense_row_ids_are_1_to_n(spark):
    df = spark.range(0, 12345, 1, 7)
    got = dense_row_ids(df, "rid")
    r = got.agg(F.min("rid"), F.max("rid"), F.countDistinct("rid"), F.count("*")).first()
    assert tuple(r) == (1, 12345, 12345, 12345)
