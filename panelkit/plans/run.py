"""The whole way from a raw CSV feed to gates, features, model, suite and chart data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import DATE_FORMATS
from panelkit.operators import charts, cleaning, features, profile, quality
from panelkit.plans import suite
from panelkit.plans.model import Model, build_all
from panelkit.session import materialise
from panelkit.sources import audit_source, read_csv, write_feature_panel

ORDER = "input_order"


@dataclass(frozen=True)
class Run:
    contract: DataFrame
    profile: DataFrame
    report: quality.QualityReport
    features: DataFrame
    model: Model
    suite: dict[str, DataFrame]
    charts: dict[str, DataFrame]


class QualityFailure(RuntimeError):
    """A CRITICAL or HIGH gate failed and the run was told to stop there."""


def run_all(
    spark: SparkSession,
    source: str,
    output: str,
    schema: T.StructType | str | None = None,
    min_entities: int = 150,
    stop_on_fail: bool = False,
    provenance: Mapping[str, str] | None = None,
    metadata: Mapping[str, str] | None = None,
    audit_path: str | None = None,
    remove_aggregates: bool = True,
    negatives: str = "zero",
    aliases: Mapping[str, str] | DataFrame | None = None,
    include_parts: bool = True,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> Run:
    """Read, clean, check, enrich, load, query.

    Of rows with the same entity and date the last one of the input is kept; the last five
    arguments are those of ``clean_panel``. The feed is read once: the job that stores the cleaned
    panel counts the rows of the feed and observes what the gates need to know. The cleaned panel, the
    features (``output/parquet``, ``output/csv``) and the model are stored because each has many
    readers; the profile of the feed, and the results of suite and charts, are lazy.
    """
    feed = read_csv(spark, source, schema, order_column=ORDER)
    fed, seen = Observation(), Observation()
    clean = cleaning.clean_panel(
        feed.observe(fed, F.count(F.lit(1)).alias("rows")),
        [ORDER],
        remove_aggregates,
        negatives,
        aliases,
        include_parts,
        date_formats,
    ).drop(ORDER)
    watched = clean.observe(seen, *quality.report_metrics(clean).columns)
    cleaned = materialise(watched, "cleaned")
    raw = feed.drop(ORDER)
    contract = profile.validate_columns(raw)
    if audit_path:
        audit_source(raw, source, source, audit_path, provenance, fed.get["rows"])
    report = quality.quality_report(cleaned, min_entities=min_entities, observed=seen.get)
    if stop_on_fail and report.summary.first()["overall_status"] == "FAIL":
        raise QualityFailure(str(report.checks.where("status = 'FAIL'").collect()))
    panel = write_feature_panel(features.feature_panel(cleaned, provenance=provenance), output)
    model = build_all(panel, metadata)
    return Run(contract, profile.profile(raw), report, panel, model, suite.run_suite(model), charts.all_charts(panel))
