"""Invariants of SURVEY §5 on the driver tables (sf0.001)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001, rows
from yardstick.operators import combine as CB
from yardstick.operators.upsert import duplicate_keys, upsert
from yardstick.params import DRIVER
from yardstick.plans.models import Panel
from yardstick.sources import panel as src


def test_merge_size_scores_bounds_and_unique_keys(spark):
    pn = Panel(spark, SF001, DRIVER)
    keys = list(CB.PANEL_KEYS)
    unmatched = pn.stg_stream.join(pn.stg_batch.select(*keys), keys, "left_anti").count()
    assert pn.combined.count() == pn.stg_batch.count() + unmatched
    assert duplicate_keys(pn.combined, keys).count() == 0
    bad = pn.scored.filter((F.col("progress_score") < 0) | (F.col("progress_score") > 100)).count()
    assert bad == 0
    assert duplicate_keys(pn.raw_stream, ["record_id"]).count() == 0
    assert duplicate_keys(E.queries()["batch_table_upsert"](spark, SF001), keys).count() == 0


def test_upsert_idempotent_on_lineitem(spark):
    li = src.read_table(spark, SF001, "lineitem").withColumn("seq", F.monotonically_increasing_id())
    once = upsert(None, li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice"], ["seq"])
    twice = upsert(once, li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice"], ["seq"])
    assert rows(once) == rows(twice)


def test_fan_out_count_on_driver_tables(spark):
    v = E.queries()["validate_messages"](spark, SF001)
    routed = E.queries()["fan_out"](spark, SF001)
    members = src.members(spark, SF001, DRIVER).select("country_code")
    valid = v.filter("valid").count()
    invalid = v.filter("not valid").count()
    member_valid = v.filter("valid").join(members, "country_code", "left_semi").count()
    assert routed.count() == 3 * valid + member_valid + invalid
