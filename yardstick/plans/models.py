"""The model graph: raw tables → staging → intermediate → marts.

``Panel`` wires the operators lazily (each attribute is a DataFrame built on
first use), so one query pulls in only the models it needs and Catalyst
optimises the whole chain at once (CTE collapse, column pruning, pushdown).
``materialize`` cuts lineage at the shared intermediates (K5 and K8) when
several marts are produced in one run, by tables in the cluster's shared
scratch folder. Building a model starts no job.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from yardstick.operators import combine as CB
from yardstick.operators import marts as M
from yardstick.operators import progress as P
from yardstick.operators import staging as S
from yardstick.params import DRIVER, PanelParams
from yardstick.session import drop_stored, stored
from yardstick.sources import panel as src


def _model(fn):
    """A lazily built model that a materialised panel may replace by its checkpoint."""
    name = fn.__name__

    def get(self):
        return self._overrides[name] if name in self._overrides else fn(self)
    get.__name__ = name
    get.__doc__ = fn.__doc__
    return cached_property(get)


class Panel:
    def __init__(self, spark: SparkSession, sf_dir: str, params: PanelParams = DRIVER,
                 overrides: dict[str, DataFrame] | None = None):
        self.spark, self.sf_dir, self.p = spark, sf_dir, params
        self._overrides: dict[str, DataFrame] = dict(overrides or {})

    # raw -------------------------------------------------------------------
    @_model
    def raw_batch(self) -> DataFrame:
        return src.raw_batch(self.spark, self.sf_dir, self.p)

    @_model
    def raw_stream(self) -> DataFrame:
        return src.raw_stream(self.spark, self.sf_dir, self.p)

    @_model
    def raw_goals(self) -> DataFrame:
        return src.raw_goals(self.spark, self.sf_dir, self.p)

    @_model
    def raw_countries(self) -> DataFrame:
        return src.raw_countries(self.spark, self.sf_dir, self.p)

    @_model
    def members(self) -> DataFrame:
        return self.raw_countries.filter("is_african").select("country_code")

    @_model
    def peers(self) -> DataFrame:
        return src.peers(self.spark, self.sf_dir, self.p)

    @_model
    def targets(self) -> DataFrame:
        return P.targets_frame(self.spark, self.p)

    # staging ----------------------------------------------------------------
    @_model
    def stg_batch(self) -> DataFrame:
        return S.stg_batch(self.raw_batch, self.p, self.members)

    @_model
    def stg_stream(self) -> DataFrame:
        return S.stg_stream(self.raw_stream, self.p)

    @_model
    def stg_goals(self) -> DataFrame:
        return S.stg_goals(self.raw_goals)

    @_model
    def stg_countries(self) -> DataFrame:
        return S.stg_countries(self.raw_countries, self.p)

    # intermediate -------------------------------------------------------------
    @_model
    def combined(self) -> DataFrame:
        return CB.combine(self.stg_batch, self.stg_stream, self.stg_goals, self.p)

    @_model
    def yoy(self) -> DataFrame:
        return P.year_over_year(self.combined)

    @_model
    def gaps(self) -> DataFrame:
        return P.target_gaps(self.combined, self.targets, self.p)

    @_model
    def scored(self) -> DataFrame:
        return P.scored(self.gaps)

    @_model
    def scores(self) -> DataFrame:
        return P.scores(self.gaps)

    # marts ----------------------------------------------------------------------
    @_model
    def fct_progress(self) -> DataFrame:
        return M.fct_progress(self.combined)

    @_model
    def fct_target_achievement(self) -> DataFrame:
        return M.fct_target_achievement(self.gaps)

    @_model
    def dim_countries(self) -> DataFrame:
        return M.dim_countries(self.stg_countries, self.scores)

    @_model
    def dim_goals(self) -> DataFrame:
        return M.dim_goals(self.stg_goals)

    @_model
    def tracker(self) -> DataFrame:
        return M.tracker(self.scores, self.stg_countries, self.p)

    @_model
    def goal_summary(self) -> DataFrame:
        return M.goal_summary(self.scores)

    @_model
    def peer_comparison(self) -> DataFrame:
        # dim_countries is the country table plus per-country score totals, one row
        # per country; the peer mart reads only region and income group, so it joins
        # the country table and skips the second aggregation over the scores
        return M.peer_comparison(self.scores, self.stg_countries, self.peers, self.p)

    def materialize(self) -> "Panel":
        """Cut lineage where several outputs share work: the raw tables (physical
        tables in the reference), the merged panel K5 and the scores K8.

        Each is written once as a parquet table in the shared scratch folder, so
        consumers prune columns and a lost executor re-reads it. The only jobs of
        this module run here and in ``write_marts``: building a model runs none.
        """
        m = Panel(self.spark, self.sf_dir, self.p, dict(self._overrides))
        for name in ("raw_batch", "raw_stream", "combined", "scores"):
            if name not in m._overrides:  # else already a table: read as it is
                m._overrides[name] = stored(getattr(m, name), name)
                m = Panel(self.spark, self.sf_dir, self.p, m._overrides)
        return m

    def release(self) -> None:
        """Delete the scratch tables of ``materialize``."""
        for df in self._overrides.values():
            drop_stored(df)


MART_NAMES = ("fct_progress", "fct_target_achievement", "dim_countries", "dim_goals", "tracker", "goal_summary",
              "peer_comparison")
VIEW_NAMES = ("stg_batch", "stg_stream", "stg_goals", "stg_countries", "combined", "yoy", "gaps", "scores")


def register_views(panel: Panel, prefix: str = "") -> list[str]:
    """Staging and intermediate models as temporary views (A12): lazy, re-expanded per query."""
    names = []
    for name in VIEW_NAMES:
        getattr(panel, name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def write_marts(panel: Panel, base: str, names=MART_NAMES) -> dict[str, str]:
    """Full rebuild of the mart tables (A13) from one materialised panel.

    The raw tables, K5 and K8 are written once (``Panel.materialize``), so the seven
    marts do not each re-run the staging and merge plans. A panel that is already materialised is used as it is.
    Each mart is published as a new version (``<base>/<mart>/v=<n>``): readers of
    ``tables.current_version`` see the previous complete version until the new
    one has been written completely.
    """
    from yardstick.sources.tables import current_version, write_version

    m = panel if {"combined", "scores"} <= set(panel._overrides) else panel.materialize()
    paths = {}
    for name in names:
        root = f"{base.rstrip('/')}/{name}"
        paths[name] = write_version(getattr(m, name), root, current_version(m.spark, root)[1] + 1)
    if m is not panel:
        m.release()
    return paths
