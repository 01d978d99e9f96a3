"""Static dimensions of the reference workload (A14, A15), built from parameters.

Each is a literal relation whose size is the length of a parameter list, so it
is broadcast (see ``operators.dims.literal_dimension``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick import schemas
from yardstick.operators.dims import literal_dimension
from yardstick.params import AFRICAN_ISO3, SDG_INDICATORS, PanelParams


def indicators(spark: SparkSession, entries=SDG_INDICATORS) -> DataFrame:
    """Indicator dictionary: code, goal, name (35 rows by default)."""
    return literal_dimension(spark, [(c, g, n) for c, g, n in entries], schemas.INDICATORS)


def member_codes(spark: SparkSession, codes=AFRICAN_ISO3) -> DataFrame:
    """The member country set (54 codes by default)."""
    return literal_dimension(spark, [(c,) for c in codes], "country_code string")


def targets(spark: SparkSession, p: PanelParams) -> DataFrame:
    """Inline target relation."""
    return literal_dimension(spark, [(c, v, d) for c, v, d in p.targets],
                             "indicator_code string, target_value string, direction string").select(
        "indicator_code", F.col("target_value").cast(schemas.VALUE).alias("target_value"), "direction")


def dimension(spark: SparkSession, name: str, p: PanelParams) -> DataFrame:
    return {"indicators": lambda: indicators(spark), "members": lambda: member_codes(spark, p.members),
            "targets": lambda: targets(spark, p)}[name]()
