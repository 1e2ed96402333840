"""Feature operators: guarded rates, rolling means, growth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from panelkit.functions import coverage_pct, per_capita, ratio_pct, round_even
from panelkit.operators.cleaning import FLOW_COLUMNS, present
from panelkit.operators.segments import windowed

WINDOWS = (7, 14, 30)
GROWTH_LAGS = {"daily_growth_rate": 1, "weekly_growth_rate": 7, "monthly_growth_rate": 30}


def trailing(entity: str | None, date: str, width: int, by: str = "rows") -> WindowSpec:
    """The last ``width`` rows (or calendar days) of an entity up to and including this one.

    ``entity=None`` is for series with one row per calendar day only.
    """
    return _trailing(Window.partitionBy(entity) if entity else Window.partitionBy(), date, width, by)


def _trailing(base: WindowSpec, date: str, width: int, by: str) -> WindowSpec:
    if by == "rows":
        return base.orderBy(date).rowsBetween(-(width - 1), Window.currentRow)
    if by == "days":
        return base.orderBy(F.unix_date(F.col(date))).rangeBetween(-(width - 1), Window.currentRow)
    raise ValueError("by must be 'rows' or 'days'")


def rolling_name(metric: str, width: int) -> str:
    return f"{width}_day_{metric.replace('new_', '') if metric.startswith('new_') else metric}_avg"


def add_rates(df: DataFrame) -> DataFrame:
    """Case fatality, per-head and coverage rates, for the inputs that are present."""
    has = set(df.columns).issuperset
    rates: dict[str, Column] = {}
    if has({"total_deaths", "total_cases"}):
        rates["case_fatality_rate"] = ratio_pct("total_deaths", "total_cases")
    if has({"population", "total_deaths"}):
        rates["death_rate"] = per_capita("total_deaths", "population", 100.0)
        rates["deaths_per_100k"] = per_capita("total_deaths", "population")
    if has({"population", "total_cases"}):
        rates["cases_per_100k"] = per_capita("total_cases", "population")
    if has({"population", "people_vaccinated"}):
        rates["vaccination_rate"] = coverage_pct("people_vaccinated", "population")
    if has({"population", "people_fully_vaccinated"}):
        rates["fully_vaccinated_rate"] = coverage_pct("people_fully_vaccinated", "population")
    return df.withColumns(rates)


def rolling_mean(
    df: DataFrame,
    entity: str = "country",
    date: str = "date",
    targets: Sequence[str] | None = None,
    windows: Sequence[int] = WINDOWS,
    by: str = "rows",
    segment: int | None = None,
) -> DataFrame:
    """Trailing mean per entity, from the first row on, nulls skipped, two decimals.

    Every target and width shares one shuffle and one sort. The panel is unique by
    (entity, date), so one task sorts at most one row per calendar day of an entity. Where that is
    too much, ``segment`` divides entities into runs of so many rows (or days), see ``segments``.
    """
    targets = present(df, FLOW_COLUMNS) if targets is None else targets

    def means(base: WindowSpec) -> dict[str, Column]:
        return {
            rolling_name(t, w): round_even(F.avg(t).over(_trailing(base, date, w, by)), 2)
            for t in targets
            for w in windows
        }

    if segment is not None and windows and targets:
        return windowed(df, entity, date, segment, max(windows) - 1, means, by)
    return df.withColumns(means(Window.partitionBy(entity)))


def growth_rates(
    df: DataFrame,
    entity: str = "country",
    date: str = "date",
    metric: str = "7_day_cases_avg",
    fallback: str = "new_cases",
    lags: Mapping[str, int] = GROWTH_LAGS,
    segment: int | None = None,
) -> DataFrame:
    """Percent change against the row 1, 7 and 30 rows back; 0 without a usable base. ``segment`` as
    in ``rolling_mean``."""
    if metric not in df.columns:
        if fallback not in df.columns:
            return df
        metric = fallback

    def growth(base: WindowSpec, rows: int) -> Column:
        earlier = F.lag(metric, rows).over(base.orderBy(date))
        change = F.when(earlier != 0, F.try_divide(F.col(metric), earlier) - 1)
        return round_even(F.coalesce(change, F.lit(0.0)) * 100.0, 2)

    def rates(base: WindowSpec) -> dict[str, Column]:
        return {name: growth(base, rows) for name, rows in lags.items()}

    if segment is not None and lags:
        return windowed(df, entity, date, segment, max(lags.values()), rates)
    return df.withColumns(rates(Window.partitionBy(entity)))


def feature_panel(
    df: DataFrame,
    entity: str = "country",
    date: str = "date",
    provenance: Mapping[str, str] | None = None,
    segment: int | None = None,
) -> DataFrame:
    """Rates, rolling means, growth, and constant provenance columns, as one lazy plan.

    ``segment`` divides entities that are too large for one task, see ``rolling_mean``.
    """
    featured = (
        df.transform(add_rates)
        .transform(
            rolling_mean,
            entity=entity,
            date=date,
            targets=present(df, ("new_cases", "new_deaths")),
            segment=segment,
        )
        .transform(growth_rates, entity=entity, date=date, segment=segment)
    )
    return featured.withColumns({k: F.lit(v) for k, v in (provenance or {}).items()})
