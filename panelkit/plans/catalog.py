"""Every operator applied to the test tables, by name.

Each entry takes (spark, table directory) and returns a DataFrame over whole tables. Operators
that work on a panel read the stored panel, features or model of ``binding``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import sources, streaming
from panelkit.functions import as_number, coverage_pct, per_capita, ratio_pct
from panelkit.operators import (
    charts,
    cleaning,
    explore,
    features,
    profile,
    quality,
    ranking,
    series,
    stats,
)
from panelkit.plans import binding, model, suite
from panelkit.session import new_path

Query = Callable[[SparkSession, str], DataFrame]

NATIONS = tuple(f"NATION_{i}" for i in range(6))
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SEGMENT_ALIASES = {"HOUSEHOLD": "HOME", "MACHINERY": "INDUSTRY", "AUTOMOBILE": "INDUSTRY"}
FEED_ALIASES = {"Nation Three": "NATION_3"}
LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
RATE_COLUMNS = (
    "cases_per_100k",
    "deaths_per_100k",
    "case_fatality_rate",
    "vaccination_rate",
    "fully_vaccinated_rate",
)
GAPPY_COLUMNS = ("new_cases", "new_deaths", "total_cases", "population")
MIN_CASES = 50_000
PANEL_SCHEMA = (
    "country_id int, date date, new_cases double, new_deaths double, country string, "
    "region string, total_cases double, total_deaths double, population long, "
    "people_vaccinated long, people_fully_vaccinated long"
)


_panel, _features, _model = binding.shared_panel, binding.shared_features, binding.shared_model
_gappy, _raw, _table = binding.gappy_panel, binding.shared_feed, binding.table


# --- ingestion -------------------------------------------------------------------------


def i1_read_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "panel-csv")
    sources.write_csv(_panel(spark, sf), path)
    return sources.read_csv(
        spark, path, PANEL_SCHEMA, columns=["country", "date", "new_cases", "population"]
    )


def i1_read_csv_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with quotes, commas and line breaks, written and read again."""
    path = new_path(spark, "documents-csv")
    sources.write_csv(_table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    schema = "doc_id long, text string, source string"
    return sources.read_csv(spark, path, schema, multi_line=True)


def i1_read_csv_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """A file with its columns in another order and one more than the schema."""
    path = new_path(spark, "customer-csv")
    customers = _table(spark, sf, "customer").select("c_mktsegment", "c_name", "c_nationkey", "c_custkey")
    sources.write_csv(customers, path)
    return sources.read_csv(spark, path, "c_custkey long, c_name string, c_mktsegment string")


def i1_read_csv_gz(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "panel-csv-gz")
    sources.write_csv(_panel(spark, sf), path, compression="gzip")
    return sources.read_csv(
        spark,
        path,
        PANEL_SCHEMA,
        columns=["country", "date", "total_cases"],
        types={"total_cases": "long"},
        repartition=spark.sparkContext.defaultParallelism,
    )


def i1_read_csv_batches(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "panel-csv")
    sources.write_csv(_panel(spark, sf).repartition(4, "country"), path)
    stream = streaming.csv_stream(
        spark, path, PANEL_SCHEMA, files_per_batch=2, columns=["country", "date", "new_deaths"]
    )
    return streaming.stream_to_parquet(stream, new_path(spark, "panel-batches"))


def i2_validate_columns(spark: SparkSession, sf: str) -> DataFrame:
    checked = profile.validate_feed(_panel(spark, sf))
    lists = ("missing_columns", "present_required_columns")
    return checked.withColumns({c: F.array_join(c, ",") for c in lists})


def i4_write_with_audit(spark: SparkSession, sf: str) -> DataFrame:
    audit = new_path(spark, "audit")
    for source, frame in (
        ("panel", _panel(spark, sf).select("country", "date")),
        ("customers", _table(spark, sf, "customer")),
        ("panel", _panel(spark, sf)),
    ):
        sources.write_with_audit(frame, new_path(spark, source), source, audit)
    return sources.latest_audit(spark, audit).select(
        "source_name",
        "record_count",
        "column_count",
        F.array_join("columns", ",").alias("columns"),
    )


def i4_read_parquet_or_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "panel-csv")
    sources.write_csv(_panel(spark, sf).select("country", "date", "new_cases"), path)
    absent = new_path(spark, "absent")
    return sources.read_parquet_or_csv(
        spark, absent, path, "country string, date string, new_cases double"
    )


# --- cleaning --------------------------------------------------------------------------


def c1_snake_case_columns(spark: SparkSession, sf: str) -> DataFrame:
    dirty = _table(spark, sf, "customer").toDF(
        " Customer Key", "Customer/Name", "Nation-Key ", "Acct.Bal (USD)", "Mkt  - Segment"
    )
    return cleaning.snake_case_columns(dirty)


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit("\t "), F.col("c_mktsegment"), F.lit(" \n"))
    return _table(spark, sf, "customer").select("c_custkey", padded.alias("segment"))


def c2_canonicalise_entity(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.canonicalise_entity(_segments(spark, sf), "segment", SEGMENT_ALIASES)


def c2_alias_hits(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.alias_hits(_segments(spark, sf), "segment", SEGMENT_ALIASES)


def c3_drop_aggregate_entities(spark: SparkSession, sf: str) -> DataFrame:
    labels = ("BUILDING", "FURNITURE")
    customers = _table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return cleaning.drop_aggregate_entities(customers, "c_mktsegment", labels)


def _mixed_dates(spark: SparkSession, sf: str) -> DataFrame:
    kind, day = F.col("o_orderkey") % 8, F.col("o_orderdate")
    layouts = (
        "yyyy-MM-dd",
        "MM/dd/yyyy",
        "MMM d, yyyy",
        "yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd'T10:00:00Z'",
        "MMMM d, yyyy",
        "'\t'd MMM yyyy' \t'",
    )
    text = F.lit("bad")
    for i, layout in enumerate(layouts):
        text = F.when(kind == i, F.date_format(day, layout)).otherwise(text)
    return _table(spark, sf, "orders").select("o_orderkey", text.alias("date"))


def c4_parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.parse_dates(_mixed_dates(spark, sf))


def c4_parse_dates_keep_invalid(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.parse_dates(_mixed_dates(spark, sf), drop_invalid=False)


def _user_days(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))


def c5_dedupe_keep(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.dedupe_keep(
        _user_days(spark, sf), ["user_id", "day"], order_by=["ts", "event_id"]
    ).drop("ts")


def c5_dedupe_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.dedupe_keep(
        _user_days(spark, sf), ["user_id", "day"], order_by=["ts", "event_id"], keep="first"
    ).drop("ts")


def c5_dedupe_whole_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.dedupe_keep(_table(spark, sf, "documents").select("text", "lang"))


def _balances(spark: SparkSession, sf: str) -> DataFrame:
    balance = F.col("c_acctbal")
    plain, segment = balance.cast("string"), F.col("c_mktsegment")
    text = F.when(segment == "BUILDING", "?").when(segment == "FURNITURE", F.concat(plain, F.lit("d")))
    text = text.otherwise(F.concat(F.lit(" "), plain, F.lit("\t")))
    return _table(spark, sf, "customer").select(
        "c_custkey",
        text.alias("new_balance"),
        balance.cast("string").alias("balance"),
    )


def c6_coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.coerce_numeric(_balances(spark, sf), ["new_balance", "balance"])


def c6_coerce_numeric_abs(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.coerce_numeric(_balances(spark, sf), ["new_balance", "balance"], "abs")


def c7_impute_panel(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.impute_panel(_gappy(spark, sf))


def c8_clean_panel(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_panel(_raw(spark, sf), order_by=["seq"], aliases=FEED_ALIASES)


# --- quality ---------------------------------------------------------------------------


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.snake_case_columns(_raw(spark, sf))


def v1_missing_and_invalid_keys(spark: SparkSession, sf: str) -> DataFrame:
    metrics = quality.panel_metrics(_feed(spark, sf), "continent", "date")
    return metrics.select("total_records", "missing_entity", "missing_date", "invalid_date")


def v2_duplicate_key_gate(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(_user_days(spark, sf), ["user_id", "day"])


def v3_exact_duplicate_gate(spark: SparkSession, sf: str) -> DataFrame:
    return quality.exact_duplicates(_table(spark, sf, "documents").select("text"))


def v4_negative_flow_gates(spark: SparkSession, sf: str) -> DataFrame:
    metrics = quality.panel_metrics(_feed(spark, sf), "location", "date")
    return metrics.select("negative_0", "negative_1")


def v5_coverage_gate(spark: SparkSession, sf: str) -> DataFrame:
    metrics = quality.panel_metrics(_feed(spark, sf), "location", "date")
    return metrics.select(
        "distinct_entities",
        F.date_from_unix_date("min_day").alias("min_date"),
        F.date_from_unix_date("max_day").alias("max_date"),
    )


def _report(spark: SparkSession, sf: str) -> quality.QualityReport:
    return quality.quality_report(_feed(spark, sf), entity="location", min_entities=30)


def v6_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf).checks


def v6_column_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf).column_nulls


def v6_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf).summary


# --- features --------------------------------------------------------------------------


def _rate(expression) -> Query:
    return lambda spark, sf: _gappy(spark, sf).select(
        "country", "date", expression().alias("rate")
    )


def t4_rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    rolled = features.rolling_mean(_gappy(spark, sf))
    return rolled.select("country", "date", *[c for c in rolled.columns if c.endswith("_avg")])


def t4_rolling_mean_days(spark: SparkSession, sf: str) -> DataFrame:
    rolled = features.rolling_mean(_panel(spark, sf), targets=["new_cases"], by="days")
    return rolled.select("country", "date", *[c for c in rolled.columns if c.endswith("_avg")])


def t5_growth_rates(spark: SparkSession, sf: str) -> DataFrame:
    grown = features.growth_rates(_panel(spark, sf), metric="new_cases")
    return grown.select("country", "date", *features.GROWTH_LAGS)


def t6_feature_panel(spark: SparkSession, sf: str) -> DataFrame:
    panel = features.feature_panel(
        _panel(spark, sf).drop("country_id"), provenance={"data_curator": "tests"}
    )
    return sources.write_feature_panel(panel, new_path(spark, "features"))


# --- model -----------------------------------------------------------------------------


def l4_build_daily_fact(spark: SparkSession, sf: str) -> DataFrame:
    return model.build_daily_fact(_features(spark, sf))


def l5_build_vaccination_fact(spark: SparkSession, sf: str) -> DataFrame:
    return model.build_vaccination_fact(_features(spark, sf))


SUITE_TEXT = """
-- entities per region; a comment line
SELECT r.region_name, count(*) AS entities
FROM countries c JOIN regions r ON c.region_id = r.region_id
GROUP BY r.region_name;

SELECT no_such_column FROM countries;

-- yearly totals
SELECT year(date) AS year, sum(new_cases) AS cases FROM daily_covid_stats GROUP BY year(date);
"""


def _suite_results(spark: SparkSession, sf: str) -> list[DataFrame]:
    _model(spark, sf).register()
    return model.run_sql_suite(spark, SUITE_TEXT)


def l6_run_sql_suite(spark: SparkSession, sf: str) -> DataFrame:
    regions, years = _suite_results(spark, sf)
    named = regions.select(F.col("region_name").alias("name"), F.col("entities").alias("value"))
    return named.union(
        years.select(F.col("year").cast("string"), F.col("cases").cast("long"))
    )


def l6_run_query(spark: SparkSession, sf: str) -> DataFrame:
    _model(spark, sf).register()
    sql = (
        "SELECT country_name, population FROM countries "
        "WHERE population >= :least ORDER BY country_name"
    )
    return model.run_query(spark, sql, {"least": 2_000_000})


# --- suite on tables that show what the integrity queries look for ----------------------


def q_dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Events per user and day, not aggregated: several events share a key."""
    daily = _table(spark, sf, "events").select(
        F.col("user_id").alias("country_id"), F.col("ts").cast("date").alias("date")
    )
    return suite.duplicate_keys(replace(_model(spark, sf), daily=daily))


def q_negative_flows(spark: SparkSession, sf: str) -> DataFrame:
    """Flows after a correction of -100 a day."""
    m = _model(spark, sf)
    corrected = m.daily.withColumn("new_cases", F.col("new_cases") - 100)
    return suite.negative_flows(replace(m, daily=corrected))


def q_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Facts against a dimension that only knows the larger entities."""
    m = _model(spark, sf)
    return suite.orphans(replace(m, countries=m.countries.where("population >= 2000000")))


def q_nonmonotonic(spark: SparkSession, sf: str) -> DataFrame:
    """The daily flow taken for a counter."""
    m = _model(spark, sf)
    flow = m.daily.withColumn("total_cases", F.col("new_cases"))
    return suite.nonmonotonic(replace(m, daily=flow))


# --- statistics and series -------------------------------------------------------------


def a1_describe_plus(spark: SparkSession, sf: str) -> DataFrame:
    return stats.describe_plus(_features(spark, sf))


def a1_describe_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return stats.describe_plus(_table(spark, sf, "lineitem"), LINE_COLUMNS)


def a2_corr_pearson(spark: SparkSession, sf: str) -> DataFrame:
    return stats.corr_pearson(_features(spark, sf), RATE_COLUMNS)


def a2_corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    lines = _table(spark, sf, "lineitem")
    return stats.corr_matrix(stats.corr_pearson(lines, LINE_COLUMNS), LINE_COLUMNS)


def a3_corr_spearman(spark: SparkSession, sf: str) -> DataFrame:
    return stats.corr_spearman(_gappy(spark, sf), GAPPY_COLUMNS)


def a3_corr_spearman_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return stats.corr_spearman(_table(spark, sf, "lineitem"), LINE_COLUMNS)


def a4_series_rolling(spark: SparkSession, sf: str) -> DataFrame:
    return series.series_rolling(_panel(spark, sf))


def a4_series_rolling_entity(spark: SparkSession, sf: str) -> DataFrame:
    return series.series_rolling(_panel(spark, sf), "NATION_3", metric="new_deaths")


def a5_detect_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return series.detect_peaks(
        _features(spark, sf), "30_day_cases_avg", entity="country", distance=45
    )


def a5_detect_peaks_total(spark: SparkSession, sf: str) -> DataFrame:
    smoothed = series.series_rolling(_panel(spark, sf))
    return series.detect_peaks(smoothed, "7d_avg", distance=60)


# --- exploration -----------------------------------------------------------------------


def _filtered(spark: SparkSession, sf: str) -> DataFrame:
    return explore.filter_panel(
        _features(spark, sf), "1996-01-01", "2000-12-31", ("AFRICA", "ASIA", "EUROPE")
    )


def _snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return explore.latest_per_entity(_filtered(spark, sf))


def d1_filter_panel(spark: SparkSession, sf: str) -> DataFrame:
    rows = explore.filter_panel(
        _features(spark, sf), "1996-01-01", "1998-12-31", REGIONS[:3], NATIONS
    )
    return rows.select("country", "region", "date", "new_cases", "total_cases")


def d2_latest_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    return explore.latest_per_entity(_gappy(spark, sf))


def global_ranks_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks of all customers by balance."""
    customers = _table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    ranks = {"dense": ("c_acctbal", "dense"), "rank": ("c_acctbal", "min")}
    return ranking.global_ranks(customers, ranks)


def on_features(operator: Callable[..., DataFrame], **parameters) -> Query:
    return lambda spark, sf: operator(_features(spark, sf), **parameters)


def on_model(operator: Callable[..., DataFrame], **parameters) -> Query:
    return lambda spark, sf: operator(_model(spark, sf), **parameters)


def with_min_cases(operator: Callable[..., DataFrame], source=_features, **parameters) -> Query:
    return lambda spark, sf: operator(source(spark, sf), min_cases=MIN_CASES, **parameters)


def queries() -> dict[str, Query]:
    return {
        "i1_read_csv": i1_read_csv,
        "i1_read_csv_documents": i1_read_csv_documents,
        "i1_read_csv_by_name": i1_read_csv_by_name,
        "i1_read_csv_gz": i1_read_csv_gz,
        "i1_read_csv_batches": i1_read_csv_batches,
        "i2_validate_columns": i2_validate_columns,
        "i3_profile": lambda spark, sf: profile.profile(_gappy(spark, sf)),
        "i3_profile_documents": lambda spark, sf: profile.profile(_table(spark, sf, "documents")),
        "i3_row_count": lambda spark, sf: profile.row_count(_table(spark, sf, "lineitem")),
        "i4_write_with_audit": i4_write_with_audit,
        "i4_read_parquet_or_csv": i4_read_parquet_or_csv,
        "c1_snake_case_columns": c1_snake_case_columns,
        "c2_canonicalise_entity": c2_canonicalise_entity,
        "c2_alias_hits": c2_alias_hits,
        "c3_drop_aggregate_entities": c3_drop_aggregate_entities,
        "c4_parse_dates": c4_parse_dates,
        "c4_parse_dates_keep_invalid": c4_parse_dates_keep_invalid,
        "c5_dedupe_keep": c5_dedupe_keep,
        "c5_dedupe_keep_first": c5_dedupe_keep_first,
        "c5_dedupe_whole_rows": c5_dedupe_whole_rows,
        "c6_coerce_numeric": c6_coerce_numeric,
        "c6_coerce_numeric_abs": c6_coerce_numeric_abs,
        "c7_impute_panel": c7_impute_panel,
        "c8_clean_panel": c8_clean_panel,
        "v1_missing_and_invalid_keys": v1_missing_and_invalid_keys,
        "v2_duplicate_key_gate": v2_duplicate_key_gate,
        "v3_exact_duplicate_gate": v3_exact_duplicate_gate,
        "v4_negative_flow_gates": v4_negative_flow_gates,
        "v5_coverage_gate": v5_coverage_gate,
        "v6_quality_report": v6_quality_report,
        "v6_column_nulls": v6_column_nulls,
        "v6_summary": v6_summary,
        "t1_ratio_pct": _rate(lambda: ratio_pct("total_deaths", "total_cases")),
        "t2_per_capita": _rate(lambda: per_capita("total_deaths", "population", 100.0)),
        "t3_coverage_pct": _rate(lambda: coverage_pct(as_number("people_vaccinated") * 3, "population")),
        "t4_rolling_mean": t4_rolling_mean,
        "t4_rolling_mean_days": t4_rolling_mean_days,
        "t5_growth_rates": t5_growth_rates,
        "t6_feature_panel": t6_feature_panel,
        "l1_build_regions": lambda spark, sf: model.build_regions(_panel(spark, sf)),
        "l2_build_entities": lambda spark, sf: model.build_entities(_panel(spark, sf)),
        "l3_build_entity_stats": lambda spark, sf: model.build_entity_stats(_panel(spark, sf)),
        "l4_build_daily_fact": l4_build_daily_fact,
        "l5_build_vaccination_fact": l5_build_vaccination_fact,
        "l6_build_all": lambda spark, sf: _model(spark, sf).counts(),
        "l6_run_sql_suite": l6_run_sql_suite,
        "l6_run_query": l6_run_query,
        "dq1_dup_keys": q_dup_keys,
        "dq2_negative_flows": q_negative_flows,
        "dq3_orphans": q_orphans,
        "dq4_nonmonotonic": q_nonmonotonic,
        "dq5_completeness": on_model(suite.completeness),
        "q1_daily_flow": on_model(suite.daily_cases),
        "q2_daily_deaths_cfr": on_model(suite.daily_deaths),
        "q3_top_cases": on_model(suite.top_cases),
        "q4_top_deaths": on_model(suite.top_deaths),
        "q5_top_cfr": with_min_cases(suite.top_fatality, _model),
        "q6_cases_per_100k": on_model(suite.cases_per_100k),
        "q7_deaths_per_100k": on_model(suite.deaths_per_100k),
        "q8_roll7_cases": on_model(suite.rolling_cases),
        "q9_roll7_deaths": on_model(suite.rolling_deaths),
        "q10_vax_status": on_model(suite.vaccination_status),
        "q11_monthly_cases": on_model(suite.monthly_cases),
        "q12_monthly_deaths": on_model(suite.monthly_deaths),
        "q13_burden_rank": on_model(suite.burden_rank),
        "q14_region_rank": on_model(suite.region_rank),
        "q15_mom_growth": on_model(suite.month_over_month),
        "q16_vax_velocity": on_model(suite.vaccination_velocity),
        "q17_vax_tiers": on_model(suite.vaccination_tiers),
        "q18_vax_cross_section": on_model(suite.vaccination_cross_section),
        "qw_wave_windows": on_model(suite.wave_windows, entities=NATIONS[:5], floor=100),
        "qd_day_zero": on_model(suite.day_zero, entities=NATIONS),
        "qn1_global_totals": on_model(suite.global_totals),
        "qn2_region_stress": on_model(suite.region_stress),
        "a1_describe_plus": a1_describe_plus,
        "a1_describe_lineitem": a1_describe_lineitem,
        "a2_corr_pearson": a2_corr_pearson,
        "a2_corr_matrix": a2_corr_matrix,
        "a3_corr_spearman": a3_corr_spearman,
        "a3_corr_spearman_lineitem": a3_corr_spearman_lineitem,
        "a4_series_rolling": a4_series_rolling,
        "a4_series_rolling_entity": a4_series_rolling_entity,
        "a5_detect_peaks": a5_detect_peaks,
        "a5_detect_peaks_total": a5_detect_peaks_total,
        "a6_compare_trajectories": on_features(series.compare_trajectories, entities=NATIONS),
        "a7_region_max_summary": on_features(series.region_max_summary),
        "c4_unparsed_dates": lambda spark, sf: cleaning.unparsed_dates(_mixed_dates(spark, sf)),
        "f1_chart_daily_cases": on_features(charts.daily_total),
        "f2_chart_daily_deaths": on_features(charts.daily_total, metric="new_deaths"),
        "f3_chart_rolling_cases": on_features(charts.rolling_of_top),
        "f4_chart_rolling_deaths": on_features(
            charts.rolling_of_top, counter="total_deaths", smoothed="7_day_deaths_avg"
        ),
        "f5_chart_top_cases": on_features(charts.top_entities),
        "f6_chart_top_deaths": on_features(charts.top_entities, counter="total_deaths"),
        "f7_chart_cfr": with_min_cases(charts.fatality_leaders),
        "f8_chart_vax_coverage": on_features(charts.coverage_over_time, since="1997-01-01"),
        "f9_chart_cases_100k": on_features(charts.per_capita_leaders),
        "f10_chart_deaths_100k": on_features(charts.per_capita_leaders, rate="deaths_per_100k"),
        "f11_chart_compare": on_features(charts.entity_comparison, entities=NATIONS),
        "f12_chart_region_trend": on_features(charts.region_trend, regions=REGIONS),
        "f12_region_trend_rows": on_features(charts.region_trend_rows),
        "f13_chart_vax_vs_cases": on_features(charts.coverage_vs_cases),
        "f14_chart_vax_vs_cfr": with_min_cases(charts.coverage_vs_fatality),
        "f14_straight_line": lambda spark, sf: charts.straight_line(
            charts.coverage_vs_fatality(_features(spark, sf), min_cases=MIN_CASES),
            "fully_vaccinated_rate",
            "case_fatality_rate",
        ),
        "f15_chart_monthly_cases": on_features(charts.monthly_total),
        "f16_chart_monthly_deaths": on_features(charts.monthly_total, metric="new_deaths"),
        "f17_chart_waves": on_features(charts.wave_timeline),
        "f17_smoothed_total": on_features(charts.smoothed_total),
        "f18_chart_month_heatmap": on_features(charts.month_heatmap_rows),
        "d1_filter_panel": d1_filter_panel,
        "d1_choices": on_features(explore.choices),
        "d2_latest_per_entity": d2_latest_per_entity,
        "d3_kpis": lambda spark, sf: explore.kpis(_snapshot(spark, sf)),
        "d4_daily_filtered": lambda spark, sf: explore.daily_filtered(_filtered(spark, sf)),
        "d5_leaderboards": lambda spark, sf: explore.leaderboards(
            _snapshot(spark, sf), min_cases=MIN_CASES
        ),
        "d5_coverage_scatter": lambda spark, sf: explore.coverage_scatter(
            _snapshot(spark, sf), min_cases=MIN_CASES / 2
        ),
        "d6_explorer_tail": lambda spark, sf: explore.explorer_tail(_filtered(spark, sf)),
        "d7_insights": lambda spark, sf: explore.insights(
            explore.daily_filtered(_filtered(spark, sf)),
            _snapshot(spark, sf),
            min_cases=MIN_CASES,
        ),
        "ranks_bucketed": global_ranks_customers,
    }
