import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quarry.operators.numbering import numbered


def plans(df):
    return df._jdf.queryExecution().toString()


def test_equals_row_number_on_a_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    got = numbered(rows.repartition(7), keys)
    assert "SinglePartition" not in plans(got)
    want = rows.withColumn("number", F.row_number().over(W.orderBy(*keys)).cast("long"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_numbers_start_anew_within_groups_of_any_size(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("g"), F.col("id") % 40)).alias("g"), F.pmod(F.xxhash64("id"), F.lit(500)).alias("x"), "id")
    got = numbered(rows, ["x", F.desc("id")], within=["g"], start=0)
    want = rows.withColumn("number", (F.row_number().over(W.partitionBy("g").orderBy("x", F.desc("id"))) - 1).cast("long"))
    assert sorted(map(tuple, got.na.fill("-").collect())) == sorted(map(tuple, want.select(got.columns).na.fill("-").collect()))


def test_numbers_stay_when_computed_again(spark):
    got = numbered(spark.range(300).select((F.col("id") % 2).alias("tie")), ["tie"])
    a, b = (got.agg(F.sum(F.xxhash64("tie", "number").cast("decimal(38,0)"))).first()[0] for _ in range(2))
    assert a == b and {r["number"] for r in got.collect()} == set(range(1, 301))


def test_edges(spark):
    assert numbered(spark.range(0), ["id"]).count() == 0
    assert numbered(spark.createDataFrame([], "g string, x int"), ["x"], within=["g"]).columns == ["g", "x", "number"]
    clash = spark.createDataFrame([(None, 9, "a"), (1, 8, "b"), (None, 7, "c")], "number int, _part int, _place string")
    got = numbered(clash, ["_part"], name="number")
    assert {(r["_part"], r["number"]) for r in got.collect()} == {(7, 1), (8, 2), (9, 3)}
    by_null = numbered(spark.createDataFrame([(None,), (2,), (None,), (1,)], "x int"), ["x"])
    assert sorted((r["number"], r["x"]) for r in by_null.collect() if r["x"]) == [(3, 1), (4, 2)]


@pytest.mark.parametrize("partitions", [1, 3])
def test_few_partitions(spark, partitions):
    got = numbered(spark.range(50).coalesce(partitions), [F.desc("id")])
    assert {(r["id"], r["number"]) for r in got.collect()} == {(i, 50 - i) for i in range(50)}
