"""Parameters of the panel operators.

Every literal the operators depend on (baseline period, horizon, valid range,
exempt metrics, targets, peer set, member set, topic names) lives in one
frozen record, so the same operators run on any (entity, metric, period,
value) panel. ``REFERENCE`` holds the defaults of the indicator-progress
workload; ``DRIVER`` holds the mapping used on the driver's TPC-H-ish tables
(see FIXTURES.md).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference workload for equal results.
# ---------------------------------------------------------------------------

# Member set: the 54 African ISO3 codes (includes SHN, lacks SYC).
AFRICAN_ISO3 = (
    "DZA", "AGO", "BEN", "BWA", "BFA", "BDI", "CPV", "CMR", "CAF", "TCD",
    "COM", "COD", "COG", "CIV", "DJI", "EGY", "GNQ", "ERI", "SWZ", "ETH",
    "GAB", "GMB", "GHA", "GIN", "GNB", "KEN", "LSO", "LBR", "LBY", "MDG",
    "MWI", "MLI", "MRT", "MUS", "MAR", "MOZ", "NAM", "NER", "NGA", "RWA",
    "STP", "SEN", "SLE", "SOM", "ZAF", "SSD", "SDN", "TZA", "TGO", "TUN",
    "UGA", "ZMB", "ZWE", "SHN",
)

# Indicator dictionary: code -> (goal, name).
SDG_INDICATORS = (
    ("SI.POV.DDAY", 1, "Poverty headcount ratio $2.15/day (%)"),
    ("SI.POV.LMIC", 1, "Poverty headcount ratio $3.65/day (%)"),
    ("SI.POV.NAHC", 1, "Poverty headcount ratio national (%)"),
    ("SN.ITK.DEFC.ZS", 2, "Prevalence of undernourishment (%)"),
    ("SH.STA.STNT.ZS", 2, "Stunting prevalence under 5 (%)"),
    ("SH.STA.WAST.ZS", 2, "Wasting prevalence under 5 (%)"),
    ("SH.DYN.MORT", 3, "Under-5 mortality rate per 1000"),
    ("SH.MMR.RISK", 3, "Lifetime risk of maternal death (%)"),
    ("SH.MMR.DTHS", 3, "Number of maternal deaths"),
    ("SH.HIV.INCD", 3, "Incidence of HIV per 1000 uninfected"),
    ("SH.TBS.INCD", 3, "Incidence of tuberculosis per 100000"),
    ("SH.MLR.INCD.P3", 3, "Incidence of malaria per 1000"),
    ("SP.DYN.LE00.IN", 3, "Life expectancy at birth (years)"),
    ("SE.PRM.ENRR", 4, "Primary school enrollment gross (%)"),
    ("SE.SEC.ENRR", 4, "Secondary school enrollment gross (%)"),
    ("SE.ADT.LITR.ZS", 4, "Literacy rate adults (%)"),
    ("SE.PRM.CMPT.ZS", 4, "Primary completion rate (%)"),
    ("SG.GEN.PARL.ZS", 5, "Women in parliament (%)"),
    ("SE.ENR.PRSC.FM.ZS", 5, "Gender parity index primary school"),
    ("SL.TLF.CACT.FE.ZS", 5, "Female labour force participation (%)"),
    ("SH.H2O.BASW.ZS", 6, "Access to basic drinking water (%)"),
    ("SH.STA.BASS.ZS", 6, "Access to basic sanitation (%)"),
    ("EG.ELC.ACCS.ZS", 7, "Access to electricity (%)"),
    ("EG.FEC.RNEW.ZS", 7, "Renewable energy share (%)"),
    ("NY.GDP.MKTP.KD.ZG", 8, "GDP growth annual (%)"),
    ("SL.UEM.TOTL.ZS", 8, "Unemployment total (%)"),
    ("SL.UEM.1524.ZS", 8, "Youth unemployment (%)"),
    ("SI.POV.GINI", 10, "Gini index"),
    ("SI.DST.10TH.10", 10, "Income share top 10% (%)"),
    ("SI.DST.FRST.20", 10, "Income share bottom 20% (%)"),
    ("EN.ATM.CO2E.PC", 13, "CO2 emissions per capita (tonnes)"),
    ("EN.ATM.CO2E.KT", 13, "CO2 emissions total (kt)"),
    ("EN.CLC.MDAT.ZS", 13, "Countries with climate adaptation plans (%)"),
    ("VC.IHR.PSRC.P5", 16, "Homicide rate per 100000"),
    ("IQ.CPA.IRAI.XQ", 16, "CPIA transparency rating"),
)

# 2030 targets: (indicator_code, target_value, direction).
SDG_TARGETS = (
    ("SI.POV.DDAY", "0.0", "lower"),
    ("SH.DYN.MORT", "25.0", "lower"),
    ("SH.MMR.RISK", "0.0", "lower"),
    ("SE.PRM.ENRR", "100.0", "higher"),
    ("SE.ADT.LITR.ZS", "100.0", "higher"),
    ("SG.GEN.PARL.ZS", "50.0", "higher"),
    ("EG.ELC.ACCS.ZS", "100.0", "higher"),
    ("SL.UEM.TOTL.ZS", "4.0", "lower"),
    ("EN.ATM.CO2E.PC", "2.0", "lower"),
    ("SH.H2O.BASW.ZS", "100.0", "higher"),
    ("SH.STA.BASS.ZS", "100.0", "higher"),
)

# Peer group compared in the peer ranking mart.
EAST_AFRICA_PEERS = ("KEN", "TZA", "UGA", "RWA", "ETH", "SSD")

# Goal pillars: inclusive goal ranges -> pillar name; anything else 'Unknown'.
PILLARS = (
    ((1, 5), "People"),
    ((6, 10), "Prosperity"),
    ((11, 15), "Planet"),
    ((16, 17), "Peace & Partnership"),
)

# Income group -> tier; anything else 0.
INCOME_TIERS = (
    ("Low income", 1),
    ("Lower middle income", 2),
    ("Upper middle income", 3),
    ("High income", 4),
)

# Progress classes: lower bound (inclusive) -> label, checked top down.
PROGRESS_CLASSES = (
    (75, "On track"),
    (50, "Moderate progress"),
    (25, "Limited progress"),
)
PROGRESS_FLOOR_LABEL = "Off track"

# Topics and their lake prefixes.
TOPIC_ALL = "sdg-indicators-raw"
TOPIC_WORLD_BANK = "sdg-world-bank-raw"
TOPIC_AFRICA = "sdg-africa-indicators"
TOPIC_VALIDATED = "sdg-validated-records"
TOPIC_FAILED = "sdg-failed-records"
TOPIC_PREFIX = (
    (TOPIC_ALL, "streaming/kafka-batches/all"),
    (TOPIC_WORLD_BANK, "streaming/kafka-batches/world-bank"),
    (TOPIC_AFRICA, "streaming/kafka-batches/africa"),
    (TOPIC_VALIDATED, "streaming/kafka-batches/validated"),
    (TOPIC_FAILED, "streaming/failed-records"),
)
UNKNOWN_TOPIC_PREFIX = "streaming/kafka-batches/unknown"

# Required message fields, in the order the validator checks them.
REQUIRED_FIELDS = ("goal", "indicator_code", "country_code", "country_name", "year", "value")

SOURCE_NAME = "World Bank Open Data"

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PanelParams:
    """Literals of the panel workload, as one record."""

    baseline_year: int = 2015
    midpoint_year: int = 2020
    horizon_year: int = 2030
    min_year: int = 2000
    max_year: int = 2030
    min_goal: int = 1
    max_goal: int = 17
    code_length: int = 3
    exempt_metrics: tuple = ("NY.GDP.MKTP.KD.ZG",)
    targets: tuple = SDG_TARGETS
    income_tiers: tuple = INCOME_TIERS
    peers: tuple = EAST_AFRICA_PEERS
    members: tuple = AFRICAN_ISO3
    # data-quality gate
    gate_min_rows: int = 100
    gate_recent_days: int = 7
    # envelope sink: consecutive offsets of a topic partition per lake object
    max_records_per_object: int = 10000
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "PanelParams":
        return replace(self, **kw)


REFERENCE = PanelParams()

# Mapping onto the driver tables (FIXTURES.md): entity = customer, metric =
# order priority, goal = leading digit of the priority, period = order year.
DRIVER_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
DRIVER_EVENT_PRIORITY = (
    ("click", "1-URGENT"),
    ("view", "2-HIGH"),
    ("signup", "3-MEDIUM"),
    ("error", "4-NOT SPECIFIED"),
    ("purchase", "5-LOW"),
)
DRIVER = PanelParams(
    baseline_year=1998,
    midpoint_year=2000,
    horizon_year=2005,
    min_year=1996,
    max_year=2001,
    code_length=10,
    exempt_metrics=("5-LOW",),
    targets=(
        ("1-URGENT", "100000", "lower"),
        ("2-HIGH", "400000", "higher"),
        ("3-MEDIUM", "50000", "lower"),
        ("5-LOW", "450000", "higher"),
    ),
    income_tiers=(("AUTOMOBILE", 1), ("BUILDING", 2), ("FURNITURE", 3), ("HOUSEHOLD", 4)),
    # peers and members are nations / a region on the driver tables; they are
    # resolved to entity codes by joins (sources.panel), not listed.
    peers=("NATION_0", "NATION_5", "NATION_10", "NATION_15", "NATION_20", "NATION_1"),
    members=("AFRICA",),
    extra={"as_of": "2024-01-31 00:00:00", "negative_below": 20000},
)
