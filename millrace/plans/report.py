"""The report over gold: one stored facility frame feeds every view."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import distribution, history, metrics
from millrace.plans.gold import DAILY, PROVIDERS, range_totals
from millrace.plans.lake import Lake
from millrace.sources.sinks import file_system


#: Fixed value: minutes after which a stored result is computed anew.
MINUTES = 30
RESULTS = "report"


class Report:
    """Report frames for a month range and a choice of filters.

    The frames behind every view, one row per facility and one per month,
    state and ownership, are computed once and stored in the lake under the
    versions of the tables they come from and the month range. Another report
    of the range reads them for ``minutes``; a refresh makes new versions, so
    its results are never served from before it. Filters apply to the stored
    frames. Where running sums of the fact are stored (``gold.refresh_sums``),
    the facilities come from two months of them instead of the days. Call ``close`` when done, or use as a context manager.
    """

    def __init__(self, lake: Lake, start: int, end: int, minutes: float = MINUTES, **choice) -> None:
        self._lake, self._minutes, self._choice = lake, minutes, choice
        tables = {name: lake.stored(name) for name in (DAILY, PROVIDERS)}
        found = {name: table.newest() for name, table in tables.items()}
        if missing := [name for name, version in found.items() if version is None]:
            raise FileNotFoundError(f"not refreshed yet: {', '.join(missing)}")
        self._state = "-".join(str(v.number) for v in found.values())
        self._range = f"{start}-{end}"
        self._totals = range_totals(lake, found[DAILY], start, end)
        self._facts = metrics.in_months(tables[DAILY].at(found[DAILY]), start, end)
        self._attributes = history.latest_attributes(
            tables[PROVIDERS].at(found[PROVIDERS]), "provnum", metrics.ATTRIBUTES
        )

    def __enter__(self) -> Report:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        if "all_facilities" in self.__dict__:
            self.all_facilities.unpersist()

    def _stored(self, name: str, result: Callable[[], DataFrame]) -> DataFrame:
        """The stored frame, computed if there is none that is young enough."""
        table = self._lake.stored(f"{RESULTS}/{self._state}/{self._range}/{name}")
        age = table.age()
        if age is None or age >= 60 * self._minutes:
            if age is None:
                self._drop_older()
            table.replace(result())
        return table.read()

    def _drop_older(self) -> None:
        """Remove results of table versions that are not current any more."""
        fs, at = file_system(self._lake.spark, self._lake.path(RESULTS))
        folder = at(self._lake.path(RESULTS))
        for state in fs.listStatus(folder) if fs.exists(folder) else []:
            if state.getPath().getName() != self._state:
                fs.delete(state.getPath(), True)

    @cached_property
    def all_facilities(self) -> DataFrame:
        return self._stored("facilities", self._facility_metrics).persist()

    def _facility_metrics(self) -> DataFrame:
        if self._totals is None:
            return metrics.facility_metrics(self._facts, self._attributes)
        return metrics.facility_ratios(self._totals, self._attributes)

    @property
    def facilities(self) -> DataFrame:
        return metrics.filter_facilities(self.all_facilities, **self._choice)

    def options(self) -> DataFrame:
        return metrics.filter_options(self.all_facilities, ["state", "ownership_type", "provider_type"])

    def headline(self) -> DataFrame:
        return metrics.headline(self.facilities)

    def staffing_histogram(self) -> DataFrame:
        return distribution.histogram(self.facilities, "hprd")

    def reliance_histogram(self) -> DataFrame:
        clipped = distribution.clipped(self.facilities, "contract_reliance", "reliance_disp")
        return distribution.histogram(clipped, "reliance_disp")

    def by_state(self) -> DataFrame:
        return metrics.by_state(self.facilities)

    def lowest_staffing(self) -> DataFrame:
        return distribution.ranking(self.facilities, "hprd", largest=False)

    def highest_mix(self) -> DataFrame:
        return distribution.ranking(self.facilities, "contract_mix", largest=True)

    def highest_reliance(self) -> DataFrame:
        return distribution.ranking(self.facilities, "contract_reliance", largest=True)

    def trend(self) -> DataFrame:
        chosen = {k: v for k, v in self._choice.items() if k in ("states", "ownerships")}
        months = self._stored("months", lambda: metrics.monthly_trend(self._facts, self._attributes))
        return metrics.system_trend(months, **chosen)

    def thresholds(self) -> DataFrame:
        return distribution.thresholds(self.facilities)

    def outliers(self) -> DataFrame:
        return distribution.flag_outliers(self.facilities)


def month_choices(lake: Lake) -> DataFrame:
    """Months the report can span, with labels; none without facts."""
    bounds = metrics.month_bounds(lake.table(DAILY))
    return metrics.month_list(bounds).where(F.col("month_key") > 0)
