"""The distributed exact rank equals a global row_number, and the split is exact."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyrec.functions.ids import hash_rank, md5_key
from tallyrec.operators.rating import holdout_split


def test_hash_rank_equals_global_row_number(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).cast("string").alias("j"))
    ranked = hash_rank(df, ["k", "j"], salt="14", bits=8)
    ref = df.withColumn("r2", F.row_number().over(Window.orderBy(md5_key("k", "j", salt="14"), "k", "j")))
    bad = ranked.join(ref, ["k", "j"]).filter(F.col("rank") != F.col("r2"))
    assert ranked.count() == 5000 and bad.count() == 0
    assert ranked.agg(F.min("rank"), F.max("rank")).first() == (1, 5000)


def test_holdout_split_is_exact(spark):
    df = spark.range(1001).select(F.col("id").cast("string").alias("cim_id"), F.lit("p").alias("post_id"),
                                  F.lit(1).alias("post_rating"))
    counts = {r.part: r["count"] for r in holdout_split(df, 0.85, 14).groupBy("part").count().collect()}
    assert counts == {"train": 850, "test": 151}
