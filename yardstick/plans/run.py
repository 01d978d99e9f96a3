"""End-to-end run: gate → models → mart tables → column tests (the transform lifecycle).

    python -m yardstick.plans.run --sf-dir /root/testdata/sf0.1 --out <shared folder> [--gate report|stop]

On a cluster, pass an ``--out`` in shared storage; lineage is cut with tables in the
folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import math
import sys
import time

from pyspark.sql import SparkSession

from yardstick.operators import quality as QC
from yardstick.params import DRIVER
from yardstick.plans.models import Panel, write_marts


MAX_PARTITIONS = 32_768
READ_TABLES = ("orders", "events", "customer", "nation", "region")


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizing for a given input volume.

    Scan splits of 256 MB. ``input_bytes`` is the size of the tables that are read;
    staging, partial aggregation and column pruning leave about an eighth of it to shuffle.
    At least 2 waves of tasks over the cores, at most MAX_PARTITIONS: map and reduce tasks
    multiply into shuffle blocks; AQE coalesces small partitions and splits large ones.
    """
    parts = min(MAX_PARTITIONS, max(2 * total_cores, math.ceil(input_bytes / 8 / target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size under ``path`` from the file system's content summary (metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def apply_scale_conf(spark: SparkSession, path: str) -> dict:
    """Set the sizing of ``recommended_conf`` for the input under ``path``.

    Only runtime SQL settings are touched, and only where the session does not
    already carry an explicit value (``spark-submit --conf`` and ``spark.conf.set`` win).
    """
    size = sum(input_bytes(spark, f"{path.rstrip('/')}/{t}.parquet") for t in READ_TABLES)
    conf = recommended_conf(size, spark.sparkContext.defaultParallelism)
    explicit = spark._jsparkSession.sessionState().conf().settings()  # set at submission or by spark.conf.set
    applied = {}
    for k, v in conf.items():
        if not explicit.containsKey(k):
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def load_raw_tables(spark: SparkSession, sf_dir: str, raw_root: str) -> dict[str, int]:
    """The loads (A9, A10): batch observations upserted into the batch raw table on the
    panel key, validated messages into the stream raw table on the record id; each
    load writes a new version of its table."""
    from pyspark.sql import functions as F

    from yardstick.operators.routing import validate
    from yardstick.sources import panel as src
    from yardstick.sources.tables import upsert_into

    batch = src.raw_batch(spark, sf_dir, DRIVER).withColumn("__load_seq", F.lit(0))  # unique per key
    vb = upsert_into(spark, f"{raw_root}/batch", batch, ["country_code", "indicator_code", "year"],
                     ["value", "extracted_at"], ["__load_seq"])
    msgs = validate(src.stream_messages(spark, sf_dir), DRIVER).filter("valid") \
        .select(*src.STREAM_COLS, "arrival_ts", "arrival_seq")
    vs = upsert_into(spark, f"{raw_root}/stream", msgs, ["record_id"], ["value", "extracted_at"],
                     ["arrival_ts", "arrival_seq"])
    return {"raw_batch": vb, "raw_stream": vs}


def run(spark: SparkSession, sf_dir: str, out: str, gate_mode: str = "stop", size: bool = False) -> dict:
    from yardstick.sources.tables import current_version

    t0 = time.perf_counter()
    sized = apply_scale_conf(spark, sf_dir) if size else {}
    raw_root = f"{out.rstrip('/')}/raw"
    versions = load_raw_tables(spark, sf_dir, raw_root)
    raw = {name: current_version(spark, f"{raw_root}/{name.split('_')[1]}")[0] for name in versions}
    # the gate reads the raw tables alone and stops the run before anything is transformed
    report = QC.gate_report(raw["raw_batch"], raw["raw_stream"], DRIVER, DRIVER.extra["as_of"]).collect()  # five rows
    if gate_mode == "stop":
        QC.gate(report)
    panel = Panel(spark, sf_dir, DRIVER, overrides=raw).materialize()  # K5, K8 written once
    paths = write_marts(panel, f"{out.rstrip('/')}/marts")
    published = {name: spark.read.parquet(path) for name, path in paths.items()}
    counts = {name: df.count() for name, df in published.items()}
    models = {m: published.get(m) if m in published else getattr(panel, m) for m, _, _ in QC.COLUMN_TESTS}
    tests = [r.asDict() for r in QC.column_tests(models).collect()]  # 28 rows
    panel.release()
    return {"raw_versions": versions, "gate": [r.asDict() for r in report], "marts": counts, "column_tests": tests,
            "failed_tests": sum(t["failures"] > 0 for t in tests), "sized": sized, "seconds": round(time.perf_counter() - t0, 2)}


def main(argv=None) -> int:
    """Exit code 1 if a column test failed; a failed gate raises before the transform."""
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--gate", choices=("stop", "report"), default="stop")
    ap.add_argument("--local", default=None, help="local[N] master for a single-machine run")
    ap.add_argument("--size", action="store_true", help="size shuffle partitions and splits from the input")
    a = ap.parse_args(argv)
    if a.local:
        from yardstick.session import build_session
        spark = build_session(a.local)
    else:
        spark = SparkSession.builder.appName("yardstick-run").getOrCreate()
    result = run(spark, a.sf_dir, a.out, a.gate, a.size)
    print(json.dumps(result, default=str))
    return int(result["failed_tests"] > 0)


if __name__ == "__main__":
    sys.exit(main())
