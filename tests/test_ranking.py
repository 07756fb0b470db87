"""Whole-table ranking keeps every row and numbers them 1..n, on inputs
large enough for adaptive execution to merge partitions differently."""

import pytest
from pyspark.sql import functions as F

from linkgap.operators.ranking import rank_positions

N = 200_000


@pytest.fixture(params=["true", "false"], ids=["coalescing", "no-coalescing"])
def many_partitions(spark, request):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield spark
    for k, v in keep.items():
        spark.conf.set(k, v)


def _wide(spark, n=N):
    return spark.range(0, n, numPartitions=16).select(
        (F.col("id") * 7919 % 1009).alias("v"), "id", (F.col("id") % 2).alias("g"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("text"))


@pytest.mark.parametrize("n", [20_000, N])
def test_every_row_is_kept_and_numbered_once(many_partitions, n):
    out = rank_positions(_wide(many_partitions, n), [F.col("v").desc(), F.col("id").asc()], "pos")
    r = out.agg(F.count("*"), F.countDistinct("pos"), F.min("pos"), F.max("pos"), F.countDistinct("id"),
                F.min(F.length("text"))).first()
    assert tuple(r) == (n, n, 1, n, n, 192)


def test_groups_are_numbered_on_their_own(many_partitions):
    out = rank_positions(_wide(many_partitions), [F.col("v").asc(), F.col("id").asc()], "pos", group="g")
    rows = out.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("pos").alias("d"), F.max("pos").alias("m"))
    assert sorted(tuple(r) for r in rows.collect()) == [(0, N // 2, N // 2, N // 2), (1, N // 2, N // 2, N // 2)]
    # the order itself, against the plain window on one slice of positions
    from pyspark.sql import Window
    plain = _wide(many_partitions).withColumn(
        "p", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").asc(), F.col("id").asc())))
    assert out.join(plain.select("id", "p"), "id").where("p <> pos").count() == 0


def test_null_group_empty_input_and_ties(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 2)], "g string, v int")
    rows = sorted((str(r.g), r.pos) for r in rank_positions(df, [F.col("v").asc()], "pos", group="g").collect())
    assert rows == [("None", 1), ("None", 2), ("a", 1)]
    assert rank_positions(df.limit(0), [F.col("v").asc()], "pos").count() == 0
