"""Time-series operators: smoothed series, peaks, trajectories."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import ratio, round_even
from panelkit.operators.features import trailing

# Entities compared by default.
BENCHMARK_ENTITIES = (
    "United States",
    "India",
    "United Kingdom",
    "Germany",
    "Brazil",
    "Italy",
    "France",
    "Japan",
    "Canada",
    "Australia",
)


def series_rolling(
    df: DataFrame,
    entity_value: str | None = None,
    metric: str = "new_cases",
    windows: Sequence[int] = (7, 14, 30),
    entity: str = "country",
    date: str = "date",
) -> DataFrame:
    """One entity's series, or the daily total of all, with trailing means (two decimals).

    The window has no partition key but at most one row per calendar day goes into it.
    """
    if entity_value is not None:
        chosen = df.where(F.col(entity) == entity_value)
        if chosen.isEmpty():
            raise ValueError(f"{entity} {entity_value!r} not found")
        series = chosen.select(date, metric)
    else:
        series = df.where(F.col(date).isNotNull()).groupBy(date).agg(F.coalesce(F.sum(metric), F.lit(0)).alias(metric))
    return series.withColumns(
        {f"{w}d_avg": round_even(F.avg(metric).over(trailing(None, date, w)), 2) for w in windows}
    )


def local_maxima(values: np.ndarray) -> np.ndarray:
    """Positions of strict local maxima; a flat top counts once, at its middle (rounded down).
    The first and the last level of the series are never maxima."""
    if len(values) < 3:
        return np.empty(0, dtype=int)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(values)) + 1))
    ends = np.concatenate((starts[1:] - 1, [len(values) - 1]))
    levels = values[starts]
    inner = np.arange(1, len(levels) - 1)
    tops = inner[(levels[inner] > levels[inner - 1]) & (levels[inner] > levels[inner + 1])]
    return (starts[tops] + ends[tops]) // 2


def keep_spaced(positions: np.ndarray, heights: np.ndarray, distance: int) -> np.ndarray:
    """Drop maxima closer than ``distance`` samples to a higher kept one. Of equal heights the
    later is served first."""
    alive = np.ones(len(positions), dtype=bool)
    for i in np.lexsort((positions, heights))[::-1]:
        if alive[i]:
            low = np.searchsorted(positions, positions[i] - distance, side="right")
            high = np.searchsorted(positions, positions[i] + distance, side="left")
            alive[low:high] = False
            alive[i] = True
    return positions[alive]


def prominence(values: np.ndarray, position: int) -> float:
    """Height above the higher of the two lowest points reached before a higher value."""
    height = values[position]
    higher = np.flatnonzero(values > height)
    at = np.searchsorted(higher, position)
    left = higher[at - 1] + 1 if at > 0 else 0
    right = higher[at] if at < len(higher) else len(values)
    return float(height - max(values[left : position + 1].min(), values[position:right].min()))


def find_waves(values: np.ndarray, distance: int, factor: float) -> list[tuple[int, float]]:
    """(position, prominence) of the maxima that are spaced and prominent enough."""
    if len(values) < distance or not len(values):
        return []
    tops = local_maxima(values)
    least = values.max() * factor
    found = ((int(p), prominence(values, p)) for p in keep_spaced(tops, values[tops], distance))
    return [(p, h) for p, h in found if h >= least]


def detect_peaks(
    series: DataFrame,
    value: str,
    entity: str | None = None,
    date: str = "date",
    distance: int = 45,
    prominence_factor: float = 0.25,
) -> DataFrame:
    """Peaks of a smoothed daily series, per entity or for one series.

    A peak is a local maximum at least ``distance`` samples from any higher one, whose prominence
    is at least ``prominence_factor`` times the maximum of the whole series. Entities run in
    parallel; a group is one series with at most one row per calendar day.
    """
    key = F.col(entity).cast("string") if entity else F.lit("all")
    points = series.where(F.col(value).isNotNull() & key.isNotNull()).select(
        key.alias("series"), F.col(date).alias("day"), F.col(value).cast("double").alias("value")
    )

    def waves(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("day", ignore_index=True)
        values = group["value"].to_numpy()
        found = find_waves(values, distance, prominence_factor)
        at = [p for p, _ in found]
        return pd.DataFrame(
            {
                "series": group["series"].iloc[at].to_numpy(),
                "wave_number": np.arange(1, len(found) + 1, dtype=np.int32),
                "peak_date": group["day"].iloc[at].to_numpy(),
                "peak_value": np.round(values[at], 2),
                "prominence": np.round([h for _, h in found], 2).astype(float),
            }
        )

    result = points.groupBy("series").applyInPandas(
        waves,
        "series string, wave_number int, peak_date date, peak_value double, prominence double",
    )
    return result.withColumnRenamed("series", entity) if entity else result.drop("series")


def compare_trajectories(
    df: DataFrame,
    entities: Sequence[str] = BENCHMARK_ENTITIES,
    metric: str = "7_day_cases_avg",
    entity: str = "country",
    date: str = "date",
) -> DataFrame:
    """One row per date, one column per named entity: first non-null value of the metric."""
    return (
        df.where(F.col(entity).isin(list(entities)))
        .groupBy(date)
        .pivot(entity, list(entities))
        .agg(F.first(metric, ignorenulls=True))
    )


def region_max_summary(
    df: DataFrame, region: str = "region", entity: str = "country", date: str = "date"
) -> DataFrame:
    """Per region: largest counters of any row, first known population, and their ratio."""
    first = F.when(F.col("population").isNotNull(), F.struct(entity, date))
    return (
        df.where(F.col(region).isNotNull())
        .groupBy(region)
        .agg(
            F.max("total_cases").alias("total_cases"),
            F.max("total_deaths").alias("total_deaths"),
            F.min_by("population", first).alias("population"),
        )
        .withColumn("cfr", ratio(F.col("total_deaths"), F.col("total_cases")) * 100)
    )
