"""Distributed row numbers equal a window row_number, also with one hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from duotier.operators.rank import dense_codes, hash_rank


def test_hash_rank_matches_a_window_with_a_hot_and_a_null_group(spark):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"g{i % 17}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string").repartition(8)
    key = F.md5(F.col("id").cast("string"))
    got = {d: sorted(map(tuple, hash_rank(df, "g", key, F.col("id"), "rn", "n", d).collect()), key=str) for d in (1, 3)}
    w = Window.partitionBy("g").orderBy(key, "id")
    want = df.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g")))
    want = sorted((tuple(r) for r in want.select("id", "g", "n", "rn").collect()), key=str)
    for rows in got.values():
        assert rows == want


def test_repeated_rows_get_numbers_of_their_own(spark):
    df = spark.createDataFrame([(1, "a")] * 5, "id long, g string")
    got = hash_rank(df, "g", F.md5(F.col("id").cast("string")), F.col("id"))
    assert sorted(r.rn for r in got.collect()) == [1, 2, 3, 4, 5]


def test_global_dense_rank(spark):
    df = spark.createDataFrame([(x,) for x in [*"ddbbaacc", None]], "c string").repartition(4)
    got = {r["c"]: r["r"] for r in dense_codes(df, "c", "r").collect()}
    assert got == {"a": 1, "b": 2, "c": 3, "d": 4}
