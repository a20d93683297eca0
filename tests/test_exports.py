import tempfile

from pyspark.sql import functions as F

from tradewh.sources.sinks import export_flat, export_layers


def test_export_continues_after_a_failing_table(spark):
    ok = spark.range(5).select(F.col("id").alias("k"))
    bad = spark.range(3).select((F.lit(1) / (F.col("id") - F.col("id"))).alias("boom"))  # ANSI: division by zero
    root = tempfile.mkdtemp(prefix="export-", dir="/tmp")
    res = export_flat(spark, {"bad_table": bad, "good_table": ok}, root)
    by_name = {r[1]: r for r in res}
    assert by_name["good_table"][2] == 5 and by_name["good_table"][3] is None
    assert by_name["bad_table"][2] is None and "DIVIDE_BY_ZERO" in by_name["bad_table"][3]


def test_export_layers_split_dims_and_fact(spark):
    root = tempfile.mkdtemp(prefix="export-", dir="/tmp")
    res = export_layers(spark, {"dim_a": spark.range(2)}, spark.range(7), root, fact_name="fact_x")
    assert [(r[0], r[1], r[2], r[3]) for r in res] == [("silver", "dim_a", 2, None), ("gold", "fact_x", 7, None)]
