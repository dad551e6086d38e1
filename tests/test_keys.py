import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators.keys import assign_dense_keys, number_rows
from tillroll.operators.upsert import insert_absent, upsert


def test_keys_equal_a_global_row_number(spark, tmp_path):
    rows = spark.range(1500).select(F.concat(F.lit("C"), F.col("id") * 7919 % 100003).alias("id"))
    keyed = assign_dense_keys(rows.repartition(7), ["id"], "key", str(tmp_path / "keys"), 40)
    expected = rows.withColumn("key", F.row_number().over(Window.orderBy("id")) + 40)
    assert keyed.count() == 1500
    assert keyed.exceptAll(expected.select(keyed.columns).withColumn("key", F.col("key").cast("long"))).isEmpty()


def test_numbers_follow_many_files(spark, tmp_path):
    path = str(tmp_path / "many")
    rows = spark.range(0, 2000, 1, 13).withColumn("flag", F.col("id") % 3 == 0)
    rows.write.option("maxRecordsPerFile", 40).partitionBy("flag").parquet(path)
    stored = spark.read.schema("id long, flag boolean").parquet(path).where("not flag")
    got = [r.id for r in number_rows(stored, "n", "id").orderBy("n").collect()]
    assert got == [i for i in range(2000) if i % 3]
    numbers = [r.n for r in number_rows(stored, "n", "id", 5).select("n").orderBy("n").collect()]
    assert numbers == list(range(6, 6 + len(got)))


def test_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "id string")
    assert assign_dense_keys(empty, ["id"], "key", str(tmp_path / "none")).count() == 0


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert {tuple(r) for r in upsert(old, new, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert [r.k for r in insert_absent(old, new, ["k"]).collect()] == [3]
    with pytest.raises(ValueError, match=r"repeated k: \[\(2,\)\]"):
        upsert(old, new.union(new.where("k = 2")), ["k"])
