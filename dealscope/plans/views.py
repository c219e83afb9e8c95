"""The view layer: every view by name, over one set of curated tables.

A view is a DataFrame function of tables and earlier views. Asking for one composes a
single logical plan; ``materialize`` writes a view that several others read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.config import SalesConfig
from dealscope.plans import activities, cohorts, deals, monthly, weekly
from dealscope.session import fresh_path

# View name -> (function, names of its inputs), in dependency order. An input "config"
# stands for the layer's settings.
VIEWS = {
    "deals_latest": (deals.deals_latest, ["deals"]),
    "deals_latest_clean": (deals.deals_latest_clean, ["deals_latest"]),
    "deals_with_company": (deals.deals_with_company, ["deals_latest", "companies"]),
    "deal_stage_durations_per_deal": (
        deals.deal_stage_durations_per_deal,
        ["deals_latest_clean", "owners"],
    ),
    "deal_kpis_monthly": (deals.deal_kpis_monthly, ["deals_latest_clean", "owners", "config"]),
    "deal_kpis_monthly_v2": (monthly.deal_kpis_monthly_v2, ["deals_latest_clean", "config"]),
    "deal_kpis_monthly_transposed": (
        monthly.deal_kpis_monthly_transposed,
        ["deal_kpis_monthly_v2"],
    ),
    "deal_kpis_weekly_last3": (weekly.deal_kpis_weekly_last3, ["deals_latest_clean", "config"]),
    "deal_kpis_weekly_last3_by_owner": (
        weekly.deal_kpis_weekly_last3_by_owner,
        ["deals_latest_clean", "owners", "config"],
    ),
    "deal_kpis_weekly_last3_transposed": (
        weekly.deal_kpis_weekly_last3_transposed,
        ["deal_kpis_weekly_last3", "config"],
    ),
    "deal_cohort_closing_rates": (cohorts.deal_cohort_closing_rates, ["deals_latest", "config"]),
    "deal_cohort_closing_rates_by_owner": (
        cohorts.deal_cohort_closing_rates_by_owner,
        ["deals_latest", "owners", "config"],
    ),
    "deal_cohort_closing_rates_transposed": (
        cohorts.deal_cohort_closing_rates_transposed,
        ["deal_cohort_closing_rates"],
    ),
    "deal_cohort_closing_rates_by_owner_transposed": (
        cohorts.deal_cohort_closing_rates_by_owner_transposed,
        ["deal_cohort_closing_rates_by_owner"],
    ),
    "activity_volume_by_owner_type_weekly": (
        activities.activity_volume_by_owner_type_weekly,
        ["activities", "owners"],
    ),
    "activity_volume_by_owner": (
        activities.activity_volume_by_owner,
        ["activities", "contacts", "deals_latest", "owners"],
    ),
    "activity_volume_by_owner_type_last3weeks_v3": (
        activities.activity_volume_by_owner_type_last3weeks,
        ["activities", "contacts", "deals_latest", "owners", "config"],
    ),
}

# Views over a recent period, with what a deal has to meet to count in them.
RECENT = {
    "deal_kpis_weekly_last3": weekly.near_period,
    "deal_kpis_weekly_last3_by_owner": weekly.near_period,
    "deal_cohort_closing_rates": cohorts.near_period,
    "deal_cohort_closing_rates_by_owner": cohorts.near_period,
    "activity_volume_by_owner_type_last3weeks_v3": activities.near_period,
}

# Order in which a view's rows are presented; views not listed have none.
PRESENTATION = {
    "deal_kpis_monthly": [("month_start", "DESC"), ("owner_name", "ASC")],
    "deal_kpis_monthly_v2": [("month_start", "ASC")],
    "deal_kpis_monthly_transposed": [("sort_order", "ASC"), ("month_start", "ASC")],
    "deal_kpis_weekly_last3": [("week_start", "ASC")],
    "deal_kpis_weekly_last3_by_owner": [("owner_name", "ASC"), ("week_start", "ASC")],
    "deal_kpis_weekly_last3_transposed": [("week_start", "ASC"), ("sort_order", "ASC")],
    "deal_cohort_closing_rates": [("cohort_month", "ASC"), ("month_start", "ASC")],
    "deal_cohort_closing_rates_by_owner": [
        ("owner_name", "ASC"),
        ("cohort_month", "ASC"),
        ("month_start", "ASC"),
    ],
    "deal_cohort_closing_rates_transposed": [("cohort_month", "ASC"), ("month_start", "ASC")],
    "deal_cohort_closing_rates_by_owner_transposed": [
        ("owner_name", "ASC"),
        ("cohort_month", "ASC"),
        ("month_start", "ASC"),
    ],
}


class ViewLayer:
    """Views over curated tables given by name, as frames or as functions that make them.

    With ``narrow_first`` a view over a recent period first looks for the deals that can
    count in it, by a filter in the scan, and takes the latest rows of those alone. It reads
    the deals twice, but only the second time whole rows of a few; that is worth it when the
    table holds more history than the period. It has no effect on a table ``deals_latest``.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
        config: SalesConfig,
        narrow_first: bool = False,
    ):
        self.spark = spark
        self.config = config
        self.narrow_first = narrow_first
        self._tables = tables
        self._frames: dict[str, DataFrame] = {}
        self._near: dict[Callable, DataFrame] = {}
        self._stored: set[str] = set(tables)

    def _latest_near(self, name: str) -> dict[str, DataFrame]:
        """Inputs of a view over a recent period that hold the deals near it alone."""
        near = RECENT.get(name)
        if near is None or not self.narrow_first or "deals_latest" in self._stored:
            return {}
        if near not in self._near:
            self._near[near] = deals.deals_latest_near(self.frame("deals"), near(self.config))
        latest = self._near[near]
        found = {"deals_latest": latest}
        if "deals_latest_clean" not in self._stored:
            found["deals_latest_clean"] = deals.deals_latest_clean(latest)
        return found

    def frame(self, name: str) -> DataFrame:
        """Table or view as a DataFrame; nothing but a count of ``narrow_first`` runs yet."""
        if name in self._frames:
            return self._frames[name]
        if name in self._tables:
            table = self._tables[name]
            self._frames[name] = table() if callable(table) else table
        else:
            function, inputs = VIEWS[name]
            given = {"config": self.config, **self._latest_near(name)}
            values = [given[i] if i in given else self.frame(i) for i in inputs]
            self._frames[name] = function(*values)
        return self._frames[name]

    def presented(self, name: str) -> DataFrame:
        """View in its presentation order, nulls last; sorting is left out of ``frame``."""
        order = PRESENTATION.get(name, [])
        columns = [
            F.asc_nulls_last(column) if direction == "ASC" else F.desc_nulls_last(column)
            for column, direction in order
        ]
        return self.frame(name).orderBy(*columns) if columns else self.frame(name)

    def materialize(self, name: str) -> DataFrame:
        """Write a view to the shared folder and let later views read it from there.

        Worth it for ``deals_latest`` when many views run: the deals are then shuffled once.
        Views composed before it keep their plan.
        """
        frame = self.frame(name)
        path = fresh_path(self.spark, name)
        frame.write.parquet(path)
        self._frames[name] = self.spark.read.schema(frame.schema).parquet(path)
        self._stored.add(name)
        return self._frames[name]

    def register(self, *names: str) -> None:
        """Create or replace temporary views, all of them by default, for use in SQL."""
        for name in names or VIEWS:
            self.frame(name).createOrReplaceTempView(name)
