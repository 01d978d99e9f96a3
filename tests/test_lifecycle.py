"""The end-to-end lifecycle (plans/run.py) and its sizing rule."""

from tests.conftest import SF001
from yardstick.plans.run import recommended_conf, run


def test_lifecycle_rerun_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "out")
    first = run(spark, SF001, out, gate_mode="report")
    second = run(spark, SF001, out, gate_mode="report")
    assert first["raw_versions"] == {"raw_batch": 1, "raw_stream": 1}
    assert second["raw_versions"] == {"raw_batch": 2, "raw_stream": 2}
    assert first["marts"] == second["marts"] and all(n > 0 for n in first["marts"].values())
    assert len(first["column_tests"]) == 28 and len(first["gate"]) == 5
    assert {r["check_name"] for r in first["gate"]} == {"min_rows", "no_null_codes", "year_range",
                                                         "no_unexpected_negatives", "recent_stream_rows"}


def test_recommended_conf_sizes_by_volume():
    small = recommended_conf(10 << 20, total_cores=8)
    big = recommended_conf(100 << 40, total_cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "16"            # at least two waves over the cores
    assert big["spark.sql.shuffle.partitions"] == "32768"           # bounded: AQE splits the rest
    mid = recommended_conf(4 << 40, total_cores=800)
    assert mid["spark.sql.shuffle.partitions"] == str((4 << 40) // 8 // (256 << 20))
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_apply_scale_conf_keeps_explicit_settings(spark):
    from yardstick.plans.run import apply_scale_conf, input_bytes
    assert input_bytes(spark, SF001) > 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        applied = apply_scale_conf(spark, SF001)
        assert "spark.sql.shuffle.partitions" not in applied            # set when the session was built
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert applied.get("spark.sql.files.maxPartitionBytes") == str(256 << 20)
    finally:
        for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(k)


def test_failed_gate_stops_before_the_transform(spark, tmp_path):
    import pytest

    from yardstick.operators.quality import GateFailed
    out = str(tmp_path / "out")
    with pytest.raises(GateFailed):
        run(spark, SF001, out, gate_mode="stop")  # two checks fail on the driver tables
    assert (tmp_path / "out" / "raw").exists() and not (tmp_path / "out" / "marts").exists()


def test_failed_column_tests_are_counted(spark, tmp_path):
    result = run(spark, SF001, str(tmp_path / "out"), gate_mode="report")
    assert result["failed_tests"] == sum(t["failures"] > 0 for t in result["column_tests"]) > 0
