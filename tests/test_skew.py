"""Skew-shaped inputs: one key, group or goal holding a third of all rows.

These check results (against brute force) on inputs shaped like the hot keys
the operators are designed for; the plans themselves aggregate before any
shuffle of such keys (see README, "Designed for 100 TB").
"""

from decimal import Decimal as D

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from yardstick.operators import combine as CB
from yardstick.operators import marts as M
from yardstick.operators.upsert import upsert
from yardstick.params import REFERENCE

N = 3000


def test_upsert_hot_record_id(spark):
    # a third of the messages carry the same record id
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("record_id"),
        F.col("id").cast("string").alias("name"),
        F.col("id").cast("decimal(18,4)").alias("value"),
        F.col("id").alias("seq"))
    out = upsert(None, df, ["record_id"], ["value"], ["seq"])
    hot = out.filter("record_id = 'hot'").first()
    assert (hot.name, hot.value) == ("0", D(N - 3))  # first name kept, last value taken
    assert out.count() == 1 + (N - N // 3)


def test_priority_union_hot_entity(spark):
    # one entity holds a third of the batch rows, keys stay unique per side
    batch = spark.range(N).select(
        F.when(F.col("id") < N // 3, F.lit("HOT")).otherwise(F.concat(F.lit("E"), F.col("id").cast("string")))
        .alias("country_code"), F.lit("X").alias("indicator_code"), F.col("id").cast("int").alias("year"),
        F.lit(1).alias("src"))
    stream = batch.withColumn("src", F.lit(2)).union(
        spark.range(10).select(F.lit("HOT"), F.lit("Y"), F.col("id").cast("int"), F.lit(2)))
    got = CB.priority_union(batch, stream)
    assert rows(got) == rows(CB.anti_join_union(batch, stream))
    assert got.filter("src = 2").count() == 10


def test_peer_histogram_all_rows_in_one_goal(spark):
    schema = ("country_code string, country_name string, goal int, goal_title string, sdg_pillar string, "
              "indicators_tracked long, avg_goal_score decimal(5,1), indicators_achieved long, "
              "indicators_on_track long, indicators_off_track long, data_as_of int")
    scores = spark.range(N).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("country_code"),
        F.lit("n").alias("country_name"),
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("int")).otherwise(F.lit(1)).alias("goal"),
        F.lit(None).cast("string").alias("goal_title"), F.lit(None).cast("string").alias("sdg_pillar"),
        F.lit(1).cast("long").alias("indicators_tracked"),
        ((F.col("id") * 7) % 1001 / 10).cast("decimal(5,1)").alias("avg_goal_score"),
        F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(2020)).toDF(*[
            f.split(" ")[0] for f in schema.split(", ")])
    countries = scores.select("country_code", F.lit("R").alias("region"), F.lit("I").alias("income_group"))
    peers = scores.select("country_code")
    got = M.peer_comparison(scores, countries, peers, REFERENCE)
    w = Window.partitionBy("goal")
    bf = scores.select("country_code",
                       F.rank().over(w.orderBy(F.desc("avg_goal_score"))).cast("long").alias("ea_rank"),
                       F.round(F.col("avg_goal_score") - F.avg("avg_goal_score").over(w), 1)
                       .cast("decimal(6,1)").alias("vs_ea_average"))
    assert rows(got, "country_code", "ea_rank", "vs_ea_average") == rows(bf)
